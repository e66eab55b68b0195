from __future__ import annotations

import datetime as dt
import uuid
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from reviewmart import jobs, session
from reviewmart.__main__ import main
from reviewmart.schemas import PURCHASES, STAGED_LOGS, STAGED_REVIEWS
from reviewmart.scratch import scratch_folder, scratch_path, scratch_root, stage
from reviewmart.sinks import writers
from reviewmart.sources import csv, tables

ROWS = [
    ("1", "s", 'He said "hi", \\ and left', 2, dt.datetime(2021, 1, 2, 3, 4, 5), Decimal("2.550"), 7, "UK"),
    ("2", "s", None, -1, dt.datetime(2021, 1, 2, 3, 4, 5, 678900), Decimal("0.001"), None, "Ö"),
    ("3", None, "  spaces  ", None, None, None, 8, "a,b"),
    ("4", "s", "two\nlines", 1, None, Decimal("99999.999"), 9, "x\\"),
]


def new_name():
    return "t_" + uuid.uuid4().hex


def bag(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def bought(spark):
    return spark.createDataFrame(ROWS, PURCHASES)


def test_csv_round_trip(spark, tmp_path, bought):
    path = str(tmp_path / "csv")
    for _ in range(2):
        writers.write_csv(bought, path)
    assert bag(csv.read_purchases(spark, path, multi_line=True)) == bag(bought)
    assert all(not p.name.endswith(".gz") for p in (tmp_path / "csv").iterdir())


def test_csv_empty_fields_are_null(spark, tmp_path):
    (tmp_path / "p.csv").write_text(
        ",".join(PURCHASES.names) + '\n1,,2,3,2021-01-02 03:04:05,2.550,,""\n'
        '5,a,"say ""x""",bad,2021-01-02,1.5,4,UK\n'
    )
    rows = bag(csv.read_purchases(spark, str(tmp_path / "p.csv")))
    assert rows == [
        ("1", None, "2", 3, dt.datetime(2021, 1, 2, 3, 4, 5), Decimal("2.550"), None, None),
        ("5", "a", 'say "x"', None, dt.datetime(2021, 1, 2), Decimal("1.500"), 4, "UK"),
    ]


def test_csv_columns_go_by_header_name(spark, tmp_path):
    (tmp_path / "r.csv").write_text(
        'extra,id_review,CID,review_str\n"a,b",5,1,good\nx,y,z,\n'
    )
    rows = csv.read_reviews(spark, str(tmp_path / "r.csv"))
    assert rows.columns == ["cid", "review_str", "id_review"]
    assert bag(rows) == [(1, "good", 5), (None, None, None)]
    assert rows.select("id_review").collect() == [(5,), (None,)]


def test_csv_without_a_column_is_an_error(spark, tmp_path):
    (tmp_path / "r.csv").write_text("cid,review\n1,good\n")
    with pytest.raises(ValueError, match="id_review"):
        csv.read_reviews(spark, str(tmp_path / "r.csv"))


def test_csv_files_with_other_headers_are_an_error(spark, tmp_path):
    (tmp_path / "1.csv").write_text("cid,review_str,id_review\n1,good,2\n")
    (tmp_path / "2.csv").write_text("id_review,review_str,cid\n1,good,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        csv.read_reviews(spark, str(tmp_path)).collect()


def test_loading_goes_by_position_and_stops_at_bad_values(spark, tmp_path):
    name = new_name()
    good = "1,s,d,2,2021-01-02 03:04:05,2.500,1,UK\n"
    (tmp_path / "p.csv").write_text("a,b,c,d,e,f,g,h\n" + good)
    jobs.load_purchases(spark, str(tmp_path / "p.csv"), name)
    assert bag(spark.table(name).select("invoice_number", "country")) == [("1", "UK")]
    (tmp_path / "q.csv").write_text("a,b,c,d,e,f,g,h\n" + good.replace(",2,", ",two,"))
    with pytest.raises(Exception, match="(?i)malformed"):
        jobs.load_purchases(spark, str(tmp_path / "q.csv"), name)
    assert bag(spark.table(name).select("invoice_number", "country")) == [("1", "UK")]
    (tmp_path / "s.csv").write_text(
        "a,b,c,d,e,f,g,h\n" + good.replace("2021-01-02 03:04:05", "1/2/2021 3:04")
    )
    jobs.load_purchases(
        spark, str(tmp_path / "s.csv"), name, timestamp_format="M/d/yyyy H:mm"
    )
    assert spark.table(name).first().invoice_date == dt.datetime(2021, 1, 2, 3, 4)


def test_loading_twice_is_loading_once(spark, tmp_path, bought):
    path, name = str(tmp_path / "csv"), new_name()
    writers.write_csv(bought, path)
    for _ in range(2):
        jobs.load_purchases(spark, path, name, multi_line=True)
    assert bag(spark.table(name)) == bag(bought)
    assert spark.table(name).schema.simpleString() == PURCHASES.simpleString()
    writers.write_csv(bought.where("invoice_number = '1'"), path)
    jobs.load_purchases(spark, path, name)
    assert bag(spark.table(name)) == bag(bought.where("invoice_number = '1'"))


def test_export_gives_the_table(spark, tmp_path, bought):
    name = new_name()
    writers.write_table(bought, name)
    jobs.export_purchases(spark, name, str(tmp_path / "out"))
    assert bag(csv.read_purchases(spark, str(tmp_path / "out"), True)) == bag(bought)


def test_create_table_leaves_rows_alone(spark, bought):
    name = f"db_{uuid.uuid4().hex}.bought"
    writers.create_table(spark, name, PURCHASES)
    assert tables.read_table(spark, name).count() == 0
    writers.full_refresh(bought, name)
    writers.create_table(spark, name, PURCHASES)
    assert bag(tables.read_table(spark, name)) == bag(bought)


def test_full_refresh_goes_by_name_and_from_itself(spark, bought):
    name = new_name()
    writers.create_table(spark, name, PURCHASES)
    writers.full_refresh(bought.select(*reversed(PURCHASES.names)), name)
    assert bag(spark.table(name)) == bag(bought)
    writers.full_refresh(spark.table(name).where("quantity > 0"), name)
    assert bag(spark.table(name)) == bag(bought.where("quantity > 0"))


def test_write_table_replaces(spark, tmp_path, bought):
    for options in ({}, {"path": str(tmp_path / "outside")}):
        name = new_name()
        writers.write_table(bought, name, options=options)
        writers.write_table(bought.limit(1), name, options=options)
        assert spark.table(name).count() == 1


def test_write_table_through_a_connector(bought):
    """Any format name is passed on; one that is not installed is an error."""
    with pytest.raises(Exception, match="(?i)no_such_connector"):
        writers.write_table(bought, "x", "no_such_connector", {"bucket": "b"})


def test_views(spark, bought):
    view = new_name()
    writers.register_views({view: bought})
    assert spark.sql(f"SELECT count(*) FROM {view}").first()[0] == len(ROWS)


def test_stage_reviews_job(spark, tmp_path):
    (tmp_path / "r.csv").write_text(
        'cid,review_str,id_review\n1,"Once ""GOOD"", now",5\n,bad,6\n2,,7\n'
    )
    out = str(tmp_path / "out")
    for _ in range(2):
        jobs.stage_reviews(spark, str(tmp_path / "r.csv"), out)
    staged = tables.read_staged_reviews(spark, out)
    assert staged.schema.simpleString() == STAGED_REVIEWS.simpleString()
    assert bag(staged) == [(1, 1, 5), (2, 0, 7), (None, 0, 6)]


def test_staged_reviews_are_merged_into_few_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for i in range(40):
        (tmp_path / "in" / f"{i}.csv").write_text(
            f"cid,review_str,id_review\n1,good,{i}\n"
        )
    raw = csv.read_reviews(spark, str(tmp_path / "in"))
    assert raw.rdd.getNumPartitions() > 1
    jobs.stage_reviews(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert len(list((tmp_path / "out").glob("*.parquet"))) == 1
    staged = tables.read_staged_reviews(spark, str(tmp_path / "out"))
    assert bag(staged) == sorted(((1, 1, i) for i in range(40)), key=repr)


def test_scratch_follows_the_cluster_setting(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert scratch_root(spark) == named.rstrip("/")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(scratch_root(spark))
    df = spark.range(5)
    assert stage(df, "x").dtypes == df.dtypes and stage(df, "x").count() == 5


def test_scratch_folder_is_gone_afterwards(spark):
    with scratch_folder(spark, "x") as folder:
        assert stage(spark.range(5), "t", folder).count() == 5
    with pytest.raises(Exception, match="(?i)not exist|not found"):
        spark.read.parquet(f"{folder}/t")


def test_shuffles_and_splits_grow_with_the_input(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    spark.range(1000).write.parquet(path)
    size = session.stored_bytes(spark, [path])
    assert size == sum(p.stat().st_size for p in (tmp_path / "t").glob("*.parquet"))

    def now():
        return [spark.conf.get(k, None) for k in (session.INITIAL, session.SPLIT)]

    before = now()
    with session.sized_for(spark, [path], [path]):
        assert now() == ["8", str(128 << 20)]
    monkeypatch.setattr(session, "INPUT_PER_PARTITION", size // 20)
    monkeypatch.setattr(session, "MAX_SCAN_TASKS", 1)
    monkeypatch.setattr(session, "_bytes", lambda text: 10)
    with session.sized_for(spark, [path], [path]):
        assert now()[0] in ("20", "21") and now()[1] == str(2 * size)
        monkeypatch.setattr(session, "MAX_SPLIT", 100)
        with session.sized_for(spark, [path]):
            assert now()[1] == "100"
        assert now()[1] == str(2 * size)
    assert now() == before


def test_shuffle_partitions_stay_of_useful_size():
    for tib in (0.001, 0.1, 1, 10, 100, 1000):
        moved = int(tib * (1 << 40))
        each = moved / session.shuffle_partitions(moved)
        assert (47 << 20) < each <= (512 << 20)
    assert session.shuffle_partitions(0) == 0


@pytest.mark.parametrize(
    "text, size",
    [("7", 7), ("134217728b", 128 << 20), ("128m", 128 << 20), ("128MB", 128 << 20),
     ("2g", 2 << 30), ("1k", 1024)],
)
def test_size_settings(text, size):
    assert session._bytes(text) == size


def test_whole_mart_by_command_line(spark, tmp_path):
    """Raw files in, seven tables out, with overlapping review deliveries."""
    raw, work = tmp_path / "raw", tmp_path / "work"
    raw.mkdir()
    head = ",".join(PURCHASES.names)
    (raw / "p.csv").write_text(
        f"{head}\n1,s,d,2,2021-01-02 03:04:05,2.500,1,UK\n"
        "1,s,d,1,2021-01-02 03:04:05,0.250,1,UK\n2,s,d,1,2021-01-02 03:04:05,1.000,2,UK\n"
        "3,s,d,9,2021-01-02 03:04:05,9.000,,UK\n"
    )
    (raw / "r1.csv").write_text("cid,review_str,id_review\n1,a good one,1\n1,bad,2\n")
    (raw / "r2.csv").write_text("cid,review_str,id_review\n1,bad,2\n5,GOOD,3\n,good,4\n")
    log = "<log><logDate>12-31-2020</logDate><device>D{0}</device><os>Apple iOS</os>" \
          "<location>L</location></log>"
    (raw / "l.csv").write_text(
        "id_review,log\n" + "".join(
            f'{i},"<reviewlog>{log.format(i)}</reviewlog>"\n' for i in (1, 2, 4)
        )
    )
    table, db = new_name(), "mart_" + uuid.uuid4().hex
    main(["load-purchases", "--input", f"{raw}/p.csv", "--table", table])
    main(["export-purchases", "--table", table, "--output", f"{work}/p"])
    for r in ("r1", "r2"):
        main(["stage-reviews", "--input", f"{raw}/{r}.csv", "--output", f"{work}/{r}"])
    main(["stage-logs", "--input", f"{raw}/l.csv", "--output", f"{work}/logs"])
    main(["build-dims", "--logs", f"{work}/logs", "--database", db])
    for _ in range(2):
        main(["build-facts", "--logs", f"{work}/logs", "--database", db,
              "--purchases", f"{work}/p", "--reviews", f"{work}/r1", f"{work}/r2",
              "--load-ts", "2024-01-01"])

    names = {t.name for t in spark.catalog.listTables(db)}
    assert {"dim_date", "dim_devices", "dim_location", "dim_os", "dim_browser",
            "fct_users", "fct_movie_analytics"} <= names
    assert bag(spark.table(f"{db}.dim_browser")) == [(1, "Apple"), (2, "Apple"), (4, "Apple")]
    assert {r.season for r in spark.table(f"{db}.dim_date").collect()} == {"winter"}
    users = spark.table(f"{db}.fct_users")
    assert bag(users.drop("insert_date")) == [
        (1, Decimal("5.250"), 2, 1), (2, Decimal("1.000"), None, None),
    ]
    fact = spark.table(f"{db}.fct_movie_analytics")
    assert bag(fact.select("review_id", "user_id", "device", "amount_spent",
                           "review_count", "review_score")) == [
        (1, 1, "D1", Decimal("5.250"), 2, 1),
        (2, 1, "D2", Decimal("5.250"), 2, 1),
        (3, 5, None, None, None, None),
        (4, None, "D4", None, None, None),
    ]
    total = users.agg(F.sum("amount_spent")).first()[0]
    assert total == Decimal("6.250")


def test_line_breaks_in_purchases_reach_the_facts(spark, tmp_path):
    """Three purchases, two of them with line breaks: no spend is lost, by no way."""
    head = ",".join(PURCHASES.names)
    (tmp_path / "p.csv").write_text(
        f'{head}\n1,s,d,2,2021-01-02 03:04:05,1.000,7,UK\n'
        '2,s,"two\nlines",3,2021-01-02 03:04:05,10.000,7,UK\n'
        '3,s,"x\ny",5,2021-01-02 03:04:05,10.000,8,UK\n'
    )
    table, out = new_name(), str(tmp_path / "out")
    jobs.load_purchases(spark, str(tmp_path / "p.csv"), table, multi_line=True)
    jobs.export_purchases(spark, table, out)
    spark.table(table).write.parquet(str(tmp_path / "parquet"))
    for name, schema in (("r", STAGED_REVIEWS), ("l", STAGED_LOGS)):
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / name))
    rest = ([str(tmp_path / "r")], str(tmp_path / "l"))
    for source, how in (
        (table, {"purchases_format": "table"}),
        (str(tmp_path / "parquet"), {"purchases_format": "parquet"}),
        (out, {"multi_line": True}),
    ):
        mart = jobs.Warehouse("mart_" + uuid.uuid4().hex)
        jobs.build_facts(spark, source, *rest, mart, **how)
        users = spark.table(mart.table("fct_users")).select("customer_id", "amount_spent")
        assert bag(users) == [(7, Decimal("32.000")), (8, Decimal("50.000"))]
    with pytest.raises(Exception, match="multi_line"):
        jobs.build_facts(spark, out, *rest, jobs.Warehouse("mart_" + uuid.uuid4().hex))
    with pytest.raises(ValueError, match="format"):
        jobs.build_facts(spark, out, *rest, mart, purchases_format="orc")


def test_reviews_with_line_breaks_are_an_error_by_default(spark, tmp_path):
    (tmp_path / "r.csv").write_text('cid,review_str,id_review\n1,"line one\nis good",5\n')
    with pytest.raises(Exception, match="multi_line"):
        jobs.stage_reviews(spark, str(tmp_path / "r.csv"), str(tmp_path / "out"))
    jobs.stage_reviews(spark, str(tmp_path / "r.csv"), str(tmp_path / "out"), multi_line=True)
    assert bag(tables.read_staged_reviews(spark, str(tmp_path / "out"))) == [(1, 1, 5)]


@pytest.mark.parametrize("outside", [False, True])
def test_a_failing_write_leaves_the_table(spark, tmp_path, bought, outside):
    options = {"path": str(tmp_path / "t")} if outside else {}
    name = new_name()
    writers.write_table(bought, name, options=options)
    failing = bought.withColumn("country", F.raise_error(F.lit("stop")).cast("string"))
    for _ in range(2):
        with pytest.raises(Exception, match="stop"):
            writers.write_table(failing, name, options=options)
        with pytest.raises(Exception, match="stop"):
            writers.full_refresh(failing, name)
        assert bag(spark.table(name)) == bag(bought)
        writers.write_table(bought, name, options=options)
    # Another schema replaces the table, too; one version is left.
    writers.write_table(bought.select("country"), name, options=options)
    assert spark.table(name).columns == ["country"]
    if outside:
        assert len([p for p in tmp_path.iterdir() if p.is_dir()]) == 1


def test_refresh_writes_once(spark, bought, monkeypatch):
    name = new_name()
    writers.create_table(spark, name, PURCHASES)
    runs = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            runs.add(batch.num_rows)
            yield batch

    writers.full_refresh(bought.mapInArrow(count, bought.schema), name)
    assert runs.value == len(ROWS) and bag(spark.table(name)) == bag(bought)
