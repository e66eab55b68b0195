"""CSV readers.

Quotes inside a quoted field are doubled, as database exports write them; a
backslash is an ordinary character.  An empty field, quoted or not, is NULL.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewmart.schemas import PURCHASES, RAW_REVIEWS, ddl
from reviewmart.sources.csv_records import csv_records

# Shared by readers and writers, so that a round trip changes nothing.
DIALECT = {"header": "true", "quote": '"', "escape": '"'}


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    multi_line: bool = False,
    by_name: bool = True,
    strict: bool = False,
    timestamp_format: str | None = None,
    folder: str | None = None,
    counted: Observation | None = None,
) -> DataFrame:
    """Files with a header line, as the columns of ``schema``.

    ``by_name`` finds the columns by the header, in any order and among others;
    all files must agree.  Otherwise they go by position and the header is
    skipped.  A value that does not parse is NULL, or an error when ``strict``.
    A row with too few or too many fields is always an error: most likely a
    quoted field holds a line break, and the row is half of one.

    ``multi_line`` allows line breaks inside quoted fields.  The files are then read at
    once, by as many tasks as without, and chunks of their lines written to ``folder`` or the scratch
    folder; see :mod:`reviewmart.sources.csv_records`.  ``timestamp_format`` is for times
    not written year first.

    Errors come up when a column is read: counting rows reads none.

    ``counted`` gets the numbers of ``rows``, of ``odd_rows`` in which something does not
    parse, and as ``nulled_<column>`` of values that are NULL for that reason.  They come
    from the pass that reads the rows, at its end; rows of a task that has to run again
    after an executor was lost are counted again.
    """
    options = {**DIALECT, "mode": "FAILFAST" if strict else "PERMISSIVE"}
    if timestamp_format:
        options["timestampNTZFormat"] = timestamp_format
    reader = spark.read.options(**options).option("multiLine", multi_line)
    if by_name:
        # Only the first line of one file is read for this.
        read_as = _in_header_order(schema, reader.csv(path).columns)
        reader = reader.option("enforceSchema", "false")
    else:
        read_as = schema
    marked = T.StructType([*read_as.fields, T.StructField(ODD_ROW, T.StringType())])
    as_read = read_as if strict else marked
    if multi_line:
        texts = _data_records(spark, path, read_as.names if by_name else None, folder)
        options |= {"multiLine": "true", "columnNameOfCorruptRecord": ODD_ROW}
        rows = texts.select(F.from_csv("text", ddl(as_read), options).alias("r")).select("r.*")
    else:
        reader = reader.option("columnNameOfCorruptRecord", ODD_ROW)
        rows = reader.schema(as_read).csv(path)
    if strict:
        return rows.select(*schema.names)
    # In every column: a filter on one of them, pushed into the reader, would else drop
    # broken rows before they are looked at.
    if counted:
        rows = _counted(rows, schema, marked, counted)
    whole = _whole(marked)
    return rows.select(*(F.when(whole, F.col(c)).alias(c) for c in schema.names))


def _counted(
    rows: DataFrame, schema: T.StructType, marked: T.StructType, counted: Observation
) -> DataFrame:
    """The rows, observed: what is NULL though its field has a text was made so."""
    texts = F.from_csv(F.col(ODD_ROW), ddl(_strings(marked.names)), _STRING_OPTIONS)
    rows = rows.withColumn(ODD_TEXTS, F.when(F.col(ODD_ROW).isNotNull(), texts))
    parsed = [f.name for f in schema if not isinstance(f.dataType, T.StringType)]
    lost = {c: F.col(c).isNull() & F.col(ODD_TEXTS)[c].isNotNull() for c in parsed}
    return rows.observe(
        counted,
        F.count(F.lit(1)).alias("rows"),
        F.count(ODD_ROW).alias("odd_rows"),
        *(F.count_if(x).alias(f"nulled_{c}") for c, x in lost.items()),
    )


def _strings(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _data_records(
    spark: SparkSession, path: str | list[str], header: list[str] | None, folder: str | None
) -> DataFrame:
    """The text of every record but the headers, which all must have these names."""
    paths = [path] if isinstance(path, str) else path
    records = csv_records(spark, paths, folder)
    first = records.where("first_record = 0 AND record = 0")
    if header is None:
        wrong = F.col("text") == ""
    else:
        names = [f"c{i}" for i in range(len(header))]
        found = F.from_csv("text", ddl(_strings([*names, ODD_ROW])), _STRING_OPTIONS)
        same = [found[n].eqNullSafe(h) | (F.lower(found[n]) == h.lower()) for n, h in zip(names, header, strict=True)]
        wrong = ~reduce(and_, same, found[ODD_ROW].isNull())
    odd = first.where(wrong).agg(F.count("*").alias("n"), F.min("file_path").alias("one")).first()
    if odd["n"]:
        raise ValueError(f"{odd['n']} CSV files have another header than {header}, one is {odd['one']}")
    return records.where("record > 0").select("text")


# Holds the text of a row in which something did not parse.
ODD_ROW = "_odd_row"
ODD_TEXTS = "_odd_texts"
_STRING_OPTIONS = {
    "quote": DIALECT["quote"],
    "escape": DIALECT["escape"],
    "multiLine": "true",
    "columnNameOfCorruptRecord": ODD_ROW,
}


def _whole(read_as: T.StructType) -> Column:
    """True, or an error for a row that does not parse even as plain strings."""
    strings = ddl(_strings(read_as.names))
    broken = F.from_csv(F.col(ODD_ROW), strings, _STRING_OPTIONS)[ODD_ROW].isNotNull()
    message = F.concat(
        F.lit("a CSV row has another number of fields than the header; if fields hold"),
        F.lit(" line breaks, read with multi_line: "),
        F.substring(ODD_ROW, 1, 200),
    )
    return F.when(F.col(ODD_ROW).isNull() | ~broken, True).otherwise(
        F.raise_error(message).cast("boolean")
    )


def _in_header_order(schema: T.StructType, header: list[str]) -> T.StructType:
    declared = {f.name.lower(): f for f in schema.fields}
    missing = declared.keys() - {name.lower() for name in header}
    if missing:
        raise ValueError(f"no column {sorted(missing)} in header {header}")
    return T.StructType(
        [declared.get(n.lower(), T.StructField(n, T.StringType())) for n in header]
    )


def read_purchases(
    spark: SparkSession,
    path: str | list[str],
    multi_line: bool = False,
    folder: str | None = None,
) -> DataFrame:
    return read_csv(spark, path, PURCHASES, multi_line, folder=folder)


def read_reviews(
    spark: SparkSession,
    path: str | list[str],
    multi_line: bool = False,
    folder: str | None = None,
    counted: Observation | None = None,
) -> DataFrame:
    return read_csv(spark, path, RAW_REVIEWS, multi_line, folder=folder, counted=counted)
