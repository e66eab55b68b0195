"""Review logs: one XML ``<log>`` element per record.

Three layouts are read.  In all of them a record that is not well-formed keeps
its row, with NULL attributes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmart.operators.row_ids import POSITION, with_file_position
from reviewmart.schemas import LOG_RECORD, RAW_LOGS, ddl
from reviewmart.sources.csv import read_csv

ROW_TAG = "log"
ROOT_TAG = "reviewlog"

# Spaces around a value belong to it: they count when the agent is split.
PARSING = {"ignoreSurroundingSpaces": "false"}


def _element(row_tag: str) -> str:
    return rf"(?s)<{row_tag}(?:\s[^>]*)?>.*?</{row_tag}>"


def parse_record(xml: Column) -> Column:
    return F.from_xml(xml, ddl(LOG_RECORD), PARSING)


def read_logs_csv(
    spark: SparkSession,
    path: str | list[str],
    row_tag: str = ROW_TAG,
    multi_line: bool = False,
    folder: str | None = None,
) -> DataFrame:
    """``id_review,log`` lines: the record brings its own id."""
    raw = read_csv(spark, path, RAW_LOGS, multi_line, folder=folder)
    xml = F.regexp_extract("log", f"({_element(row_tag)})", 1)
    record = parse_record(xml)
    return raw.select("id_review", record.alias("r")).select("r.*", "id_review")


# Whichever begins first; neither begins inside the other.
SECTION = r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>"


def _plain_sections(text: Column) -> Column:
    """Without comments, and with CDATA sections as escaped text: no tags in either.

    A section that does not end in the text is an error.
    """
    sections = F.regexp_extract_all(text, F.lit(SECTION), F.lit(0))
    between = F.split(text, SECTION)
    torn = F.exists(between, lambda x: F.contains(x, F.lit("<!--")) | F.contains(x, F.lit("<![CDATA[")))
    message = F.concat(
        F.lit("a closing tag lies inside a comment or CDATA section; read with another"),
        F.lit(" layout than text: "),
        F.substring(text, 1, 200),
    )

    def plain(part: Column, i: Column) -> Column:
        section = F.coalesce(F.get(sections, i), F.lit("<!---->"))
        inside = F.substr(section, F.lit(10), F.length(section) - 12)
        escaped = F.replace(inside, F.lit("&"), F.lit("&amp;"))
        escaped = F.replace(escaped, F.lit("<"), F.lit("&lt;"))
        kept = F.when(F.startswith(section, F.lit("<!--")), F.lit("")).otherwise(escaped)
        return F.concat(part, kept)

    joined = F.array_join(F.transform(between, plain), "")
    found = F.when(torn, F.raise_error(message).cast("string")).otherwise(joined)
    return F.when(F.contains(text, F.lit("<!")), found).otherwise(text)


def read_logs_text(
    spark: SparkSession, path: str | list[str], row_tag: str = ROW_TAG
) -> DataFrame:
    """Files of records in any arrangement, on one line or over many, no ids.

    The text is cut at the closing tag, so large files are read by many tasks, and each
    part at its opening tags: every opening tag outside comments and CDATA sections is a
    record, an empty element (``<log/>``) too.  A closing tag *inside* a comment or CDATA
    section cuts that in two, which is an error, as is a file that ends inside a record.
    Rows carry their file position, for ``number_rows``.
    """
    paths = [path] if isinstance(path, str) else path
    closing = f"</{row_tag}>"
    opening = rf"<{row_tag}(?:\s[^>]*)?/?>"
    # Cut behind the tag's first character, which stays: a part that does not end with it
    # was ended by the end of the file.
    scan = spark.read.option("lineSep", closing[1:]).text(paths)
    scan = scan.where(F.col("value").rlike(opening)).select("value", "_metadata")
    closed = F.endswith("value", F.lit("<"))
    body = F.when(closed, F.left("value", F.length("value") - 1)).otherwise(F.col("value"))
    chunks = scan.select(_plain_sections(body).alias("value"), closed.alias("closed"), "_metadata")
    # A part but the last is followed by an opening tag, not by the closing one.
    parts = F.split("value", rf"(?={opening})")
    parts = chunks.select("closed", F.size(parts).alias("n"), F.posexplode(parts), "_metadata")
    text = F.col("col")
    spaced = rf"(?s)^(.*?</{row_tag})\s+>"
    message = F.concat(
        F.lit(f"a file ends inside a record, or {closing[1:]!r} stands in a text: "),
        F.substring(text, 1, 200),
    )
    record = (
        F.when(text.rlike(rf"^<{row_tag}(?:\s[^>]*)?/>"), F.regexp_extract(text, f"^{opening}", 0))
        .when(text.rlike(spaced), F.concat(F.regexp_extract(text, spaced, 1), F.lit(">")))
        .when(F.col("pos") < F.col("n") - 1, text)
        .when(F.col("closed"), F.concat(text, F.lit(closing)))
        .otherwise(F.raise_error(message).cast("string"))
    )
    records = parts.where(text.rlike(f"^{opening}")).select(record.alias("xml"), "_metadata")
    parsed = parse_record(F.col("xml")).alias("r")
    return with_file_position(records).select(parsed, *POSITION).select("r.*", *POSITION)


def read_logs_xml(
    spark: SparkSession,
    path: str | list[str],
    row_tag: str = ROW_TAG,
    root_tag: str = ROOT_TAG,
    single_root: bool = False,
) -> DataFrame:
    """XML files by Spark's XML source, no ids.

    For files ``read_logs_text`` cannot: closing tags inside comments or CDATA.  With
    ``single_root`` a parser reads them that knows all of XML, but wants whole documents
    of one root element; the other one takes any row of records, but misreads closing
    tags with spaces, comments that hold tags, and empty elements.  Spark reads each file
    in one task, so deliver many files.  Rows carry their file position, for
    ``number_rows``.
    """
    reader = spark.read.format("xml").schema(LOG_RECORD).options(**PARSING)
    reader = reader.option("rowTag", row_tag).option("rootTag", root_tag)
    rows = reader.option("useLegacyXMLParser", not single_root).load(path)
    return with_file_position(rows.select("*", "_metadata"))
