from __future__ import annotations

import datetime as dt
import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from reviewmart import jobs
from reviewmart.operators.row_ids import number_rows
from reviewmart.plans import dims
from reviewmart.plans.staging import split_os_browser
from reviewmart.schemas import STAGED_LOGS
from reviewmart.scratch import stage
from reviewmart.sources.review_logs import (
    read_logs_csv,
    read_logs_text,
    read_logs_xml,
)
from reviewmart.sources.tables import read_staged_logs
from conftest import plan_text


def staged(spark, rows):
    """Staged logs from (id, os, logDate)."""
    return spark.createDataFrame(
        [("d", "1.1.1.1", "l", day, agent, "p", i) for i, agent, day in rows],
        STAGED_LOGS,
    )


def test_split_truth_table(spark):
    want = {
        "Apple iOS": ("Apple", "iOS"),
        "Linux": (None, "Linux"),
        "a b c": (None, "a"),
        "": (None, ""),
        None: (None, None),
        " iOS": ("", "iOS"),
        "iOS ": ("iOS", ""),
        "A  B": (None, "A"),
        "tab\there": (None, "tab\there"),
    }
    logs = staged(spark, [(i, a, "04-25-2021") for i, a in enumerate(want)])
    got = {r.id_review: (r.browser, r.os) for r in split_os_browser(logs).collect()}
    assert got == dict(enumerate(want.values()))


@settings(max_examples=5, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab \té", max_size=8), min_size=1, max_size=100))
def test_split_random_agents(spark, agents):
    def split(agent):
        words = agent.split(" ")
        return (words[0], words[1]) if len(words) == 2 else (None, words[0])

    logs = staged(spark, [(i, a, "04-25-2021") for i, a in enumerate(agents)])
    got = {r.id_review: (r.browser, r.os) for r in split_os_browser(logs).collect()}
    assert got == {i: split(a) for i, a in enumerate(agents)}


def test_contact_columns_only_on_request(spark):
    logs = staged(spark, [(1, "a b", "04-25-2021")])
    assert split_os_browser(logs).columns == [
        "id_review", "device", "location", "logDate", "os", "browser",
    ]
    assert split_os_browser(logs, contact=True).columns == [
        "id_review", "device", "ipAddress", "location", "logDate", "os",
        "phoneNumber", "browser",
    ]


def test_dim_date(spark):
    days = ["04-25-2021", "2021-04-25", None, "13-01-2021", "02-29-2021", "02-29-2020"]
    logs = split_os_browser(staged(spark, [(i, "x", d) for i, d in enumerate(days)]))
    none = (None,) * 5
    rows = sorted(map(tuple, dims.dim_date(logs).collect()))
    assert rows == [
        (0, dt.date(2021, 4, 25), "25", "4", "2021", "spring"),
        (1, *none),
        (2, *none),
        (3, *none),
        (4, *none),
        (5, dt.date(2020, 2, 29), "29", "2", "2020", "winter"),
    ]


def test_seasons(spark):
    logs = split_os_browser(
        staged(spark, [(m, "x", f"{m:02d}-01-2021") for m in range(1, 13)])
    )
    rows = dims.dim_date(logs).select("id_dim_date", "season").collect()
    assert dict(rows) == {
        12: "winter", 1: "winter", 2: "winter", 3: "spring", 4: "spring", 5: "spring",
        6: "summer", 7: "summer", 8: "summer", 9: "autumn", 10: "autumn", 11: "autumn",
    }


def test_every_dimension_keeps_every_log(spark):
    # Repeated ids, equal values and missing browsers all stay.
    rows = [(1, "a b", "04-25-2021"), (1, "a b", "04-25-2021"), (2, "c", None)]
    logs = split_os_browser(staged(spark, rows))
    for name, dim in dims.DIMENSIONS.items():
        df = dim(logs)
        assert df.columns[0] == f"id_{name}"
        assert sorted(r[0] for r in df.collect()) == [1, 1, 2], name
    browsers = dims.dim_browser(logs).collect()
    assert sorted(str(r.browser) for r in browsers) == ["None", "a", "a"]


def record(i, gap=""):
    return (
        f"<log>{gap}<logDate>04-25-2021</logDate>{gap}<device>D{i}</device>{gap}"
        f"<location>a &lt; b &amp; {'x' * (i * 7 % 40)}</location>{gap}<os>Apple iOS</os>"
        f"{gap}<ipAddress>1.2.3.{i}</ipAddress>{gap}<phoneNumber>{i}</phoneNumber>{gap}</log>"
    )


def write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", newline="") as f:
        f.write(text)


def test_csv_logs_keep_their_id(spark, tmp_path):
    lines = ["id_review,log"]
    lines += [f'{i},"<reviewlog>{record(i)}</reviewlog>"' for i in (7, 3, 7)]
    lines += ["4,<reviewlog><log><os>broken</reviewlog>", "5,", "x,<log><os>a</os></log>"]
    write(tmp_path / "in", "records.csv", "\n".join(lines) + "\n")
    got = read_logs_csv(spark, str(tmp_path / "in"))
    assert sorted(got.columns) == sorted(STAGED_LOGS.names)
    rows = sorted(
        ((r.id_review, r.device, r.os) for r in got.collect()),
        key=lambda r: (r[0] is None, r),
    )
    assert rows == [
        (3, "D3", "Apple iOS"),
        (4, None, None),
        (5, None, None),
        (7, "D7", "Apple iOS"),
        (7, "D7", "Apple iOS"),
        (None, None, "a"),
    ]
    assert {r.location for r in got.where("id_review = 3").collect()} == {
        "a < b & " + "x" * 21
    }


# Records per file, uneven on purpose; one file has none.
FILES = {"a.xml": 40, "b.xml": 0, "c.xml": 3, "d.xml": 200, "sub-e.xml": 1}


def write_files(folder, one_line):
    i = 0
    for name, n in FILES.items():
        gap, between = ("", "\n") if one_line else ("\n  ", "\n\n")
        body = []
        for _ in range(n):
            i += 1
            body.append(record(i, gap))
        write(folder, name, "<reviewlog>\n" + between.join(body) + "\n</reviewlog>\n")
    return i


@pytest.mark.parametrize("reader", [read_logs_text, read_logs_xml])
@pytest.mark.parametrize("one_line", [True, False])
@pytest.mark.parametrize("split", ["300", "1500", "100000000"])
def test_row_ids_in_file_order(spark, tmp_path, conf, reader, one_line, split):
    conf(spark__sql__files__maxPartitionBytes=split,
         spark__sql__files__openCostInBytes="100")
    n = write_files(tmp_path / "in", one_line)
    placed = reader(spark, str(tmp_path / "in"))
    if reader is read_logs_text and split == "300":
        assert placed.rdd.getNumPartitions() > 50
    written = stage(placed, "test-logs")
    for max_broadcast in (1 << 20, 0):
        got = number_rows(written, "id_review", max_broadcast)
        rows = got.select("id_review", "device", "phoneNumber").collect()
        assert sorted(map(tuple, rows)) == [
            (i, f"D{i}", str(i)) for i in range(1, n + 1)
        ]


def test_a_file_read_twice_is_an_error(spark, tmp_path):
    write_files(tmp_path / "in", one_line=True)
    twice = [str(tmp_path / "in"), str(tmp_path / "in" / "d.xml")]
    written = stage(read_logs_text(spark, twice), "test-logs")
    with pytest.raises(ValueError, match="twice"):
        number_rows(written, "id_review")


def test_no_records_at_all(spark, tmp_path):
    write(tmp_path / "in", "a.xml", "<reviewlog></reviewlog>")
    out = str(tmp_path / "out")
    jobs.stage_logs(spark, str(tmp_path / "in"), out, "text")
    assert read_staged_logs(spark, out).count() == 0


def test_several_records_on_a_line_and_broken_ones(spark, tmp_path):
    write(tmp_path / "in", "a.txt",
          f"junk {record(1)}{record(2)} <logDate>no</logDate>\n<log><os>x</log>\n"
          f"<log kind='k'><os>y</os></log><logs><log>\n<os>z</os></log></logs> tail")
    written = stage(read_logs_text(spark, str(tmp_path / "in")), "test-logs")
    got = number_rows(written, "id").orderBy("id").select("id", "os").collect()
    assert list(map(tuple, got)) == [
        (1, "Apple iOS"), (2, "Apple iOS"), (3, None), (4, "y"), (5, "z"),
    ]


@pytest.mark.parametrize("reader", [read_logs_text, read_logs_xml])
def test_values_are_kept_as_written(spark, tmp_path, reader):
    write(tmp_path / "in", "a.xml",
          "<reviewlog><log><os> iOS</os><device>a<!-- no -->b</device></log>"
          "<log x='1'><os k='v'>w</os><device></device></log>"
          "<log><os><![CDATA[ x<y ]]></os><device>&#233;&quot;</device></log>"
          "<log></log></reviewlog>")
    got = reader(spark, str(tmp_path / "in")).orderBy("scan_order")
    assert list(map(tuple, got.select("os", "device").collect())) == [
        (" iOS", "ab"), ("w", ""), (" x<y ", 'é"'), (None, None),
    ]


@pytest.mark.parametrize("layout", ["text", "xml"])
def test_stage_logs_job(spark, tmp_path, layout):
    n = write_files(tmp_path / "in", one_line=False)
    out = str(tmp_path / "out")
    for _ in range(2):
        jobs.stage_logs(spark, str(tmp_path / "in"), out, layout)
    logs = read_staged_logs(spark, out)
    assert logs.columns == STAGED_LOGS.names
    assert sorted(r.id_review for r in logs.collect()) == list(range(1, n + 1))


def test_stage_logs_unknown_layout(spark, tmp_path):
    with pytest.raises(ValueError):
        jobs.stage_logs(spark, str(tmp_path), str(tmp_path / "out"), "json")


def test_numbering_moves_no_rows(spark, tmp_path):
    write_files(tmp_path / "in", one_line=True)
    written = stage(read_logs_text(spark, str(tmp_path / "in")), "test-logs")
    plan = number_rows(written, "id_review").select("id_review", "device")
    plan = plan._jdf.queryExecution().executedPlan().toString()
    # The join with the offsets comes first; all shuffles are on its other side.
    lines = plan.splitlines()
    join = next(i for i, l in enumerate(lines) if "BroadcastHashJoin" in l)
    rows = next(i for i, l in enumerate(lines) if "device" in l and "FileScan" in l)
    build = next(i for i, l in enumerate(lines) if "BroadcastExchange" in l)
    assert join < rows < build
    assert not any("Exchange" in l for l in lines[:build])


def test_dimension_plans_are_narrow(spark, tmp_path):
    path = str(tmp_path / "logs")
    staged(spark, [(1, "a b", "04-25-2021")]).write.parquet(path)
    logs = split_os_browser(read_staged_logs(spark, path))
    for dim in dims.DIMENSIONS.values():
        plan = plan_text(dim(logs))
        assert "Exchange" not in plan and "Python" not in plan


def test_dimensions_read_only_their_columns(spark, tmp_path):
    path = str(tmp_path / "logs")
    staged(spark, [(1, "a b", "04-25-2021")]).write.parquet(path)
    logs = split_os_browser(read_staged_logs(spark, path))
    plan = plan_text(dims.dim_os(logs))
    assert "ReadSchema: struct<os:string,id_review:bigint>" in plan


ODD = {
    "a comment with a tag before": ("<log><os>a</os></log><!-- <log> --><log><os>b</os></log>", "ab"),
    "a comment with a tag inside": ("<log><!-- <log> --><os>a</os></log><log><os>b</os></log>", "ab"),
    "an empty element": ("<log><os>a</os></log><log /><log><os>b</os></log>", "a-b"),
    "no space in it": ("<log><os>a</os></log><log/><log><os>b</os></log>", "a-b"),
    "a closing tag with a space": ("<log><os>a</os></log ><log><os>b</os></log\n><log><os>c</os></log>", "abc"),
    "tags in CDATA": ("<log><os><![CDATA[<log>]]></os></log><log><os>b</os></log>", ["<log>", "b"]),
    "CDATA with an ampersand": ("<log><os><![CDATA[&lt;]]></os></log>", ["&lt;"]),
    "a comment's ends in two CDATAs": (
        "<log><os><![CDATA[a <!-- b]]></os></log><log><os><![CDATA[c --> d]]></os></log>",
        ["a <!-- b", "c --> d"],
    ),
    "CDATA in a comment": ("<log><!-- <![CDATA[ --><os>a</os></log><log><os>b]]&gt;</os></log>", ["a", "b]]>"]),
    "two sections of each kind": (
        "<log><!-- 1 --><os><![CDATA[x]]>y<!-- <![CDATA[2]]> --><![CDATA[<z>]]></os></log>",
        ["xy<z>"],
    ),
}


@pytest.mark.parametrize("name", ODD)
def test_odd_records_keep_their_place(spark, tmp_path, name):
    text, due = ODD[name]
    due = [None if x == "-" else x for x in due]
    write(tmp_path / "in", "a.xml", f"<reviewlog>{text}</reviewlog>")
    for layout in ("text", "xml-document"):
        jobs.stage_logs(spark, str(tmp_path / "in"), str(tmp_path / layout), layout)
        got = read_staged_logs(spark, str(tmp_path / layout)).orderBy("id_review")
        assert [(r.id_review, r.os) for r in got.collect()] == list(enumerate(due, 1)), layout


def test_a_record_without_closing_tag_keeps_its_place(spark, tmp_path):
    write(tmp_path / "in", "a.xml", "<log><os>a</os></log><log><os>x</os><log><os>c</os></log>")
    got = read_logs_text(spark, str(tmp_path / "in")).orderBy("scan_order")
    assert [r.os for r in got.collect()] == ["a", None, "c"]


@pytest.mark.parametrize("text", ["<!-- </log> -->", "<os><![CDATA[</log>]]></os>"])
def test_a_section_cut_in_two_is_an_error(spark, tmp_path, text):
    write(tmp_path / "in", "a.xml", f"<reviewlog><log>{text}<os>a</os></log></reviewlog>")
    with pytest.raises(Exception, match="layout"):
        read_logs_text(spark, str(tmp_path / "in")).collect()


@pytest.mark.parametrize(
    "text",
    [
        "<log><device>b</device>",
        "<log><device>b</device></log",
        "<log><device>a</device></log>\n<log kind='x'><device>b",
        "<log><device>b/log></device></log>",
    ],
)
def test_a_file_that_ends_inside_a_record_is_an_error(spark, tmp_path, text):
    write(tmp_path / "in", "a.xml", f"<reviewlog><log><os>a</os></log>{text}")
    write(tmp_path / "in", "b.xml", "<log><os>a</os></log><log><os>x</os></log >")
    with pytest.raises(Exception, match="ends inside a record"):
        read_logs_text(spark, str(tmp_path / "in")).collect()


def test_numbering_ends_in_no_single_task(spark, tmp_path, monkeypatch):
    from reviewmart.operators import row_ids

    seen = []
    real = row_ids.stage

    def watched(df, *rest):
        seen.append(plan_text(df))
        return real(df, *rest)

    monkeypatch.setattr(row_ids, "stage", watched)
    write_files(tmp_path / "in", one_line=True)
    written = stage(read_logs_text(spark, str(tmp_path / "in")), "test-logs")
    seen.append(plan_text(number_rows(written, "id_review")))
    assert len(seen) == 3 and not any("SinglePartition" in plan for plan in seen)
