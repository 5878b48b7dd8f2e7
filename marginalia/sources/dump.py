"""Page dumps in XML."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

# Only the fields that are used: the XML parser skips all others.
PAGE_SCHEMA = StructType(
    [
        StructField("title", StringType()),
        StructField("ns", LongType()),
        StructField(
            "revision",
            StructType(
                [
                    StructField(
                        "text",
                        StructType(
                            [
                                StructField("_VALUE", StringType()),
                                StructField("_xml:space", StringType()),
                            ]
                        ),
                    )
                ]
            ),
        ),
    ]
)
PAGE_START, PAGE_END = "<page>", "</page>"
XML_OPTIONS = {"rowTag": "page", "ignoreSurroundingSpaces": "false"}
REJECTED = "_corrupt_record"
RECORD_SCHEMA = StructType([*PAGE_SCHEMA, StructField(REJECTED, StringType())])


def spread_out(rows: DataFrame, tasks: int | None) -> DataFrame:
    """Deal the rows out over so many tasks; None leaves them as the source splits them.

    Cleaning costs far more than reading, and one compressed dump or one row group would keep
    it all in one task.
    """
    return rows.repartition(tasks) if tasks else rows


def scan_dump_records(spark: SparkSession, path: str, tasks: int | None = None) -> DataFrame:
    """``(title, ns, text, reject)``, one row per start of a page, in as many tasks as the file has
    splits, or in ``tasks``, which a compressed dump that cannot be split needs.

    ``reject`` is null for a page, and else the record, without its end tag and blanks around it, that
    is none: it is not well-formed, its namespace is no number, or the next page starts before it
    ends. Pages and rejects come from one parse.

    The XML reader takes one big file in a single task, while the text reader splits it at any
    record separator. So the end tag parts the records, and each record is parsed on its own.
    The parsed record comes out of a generator: a filter on it cannot move below and parse the
    record once more.
    """
    records = spark.read.option("lineSep", PAGE_END).text(path)
    found = spread_out(records.filter(F.contains("value", F.lit(PAGE_START))), tasks)
    starts = found.select(F.split("value", PAGE_START).alias("starts"))
    pages = starts.select(F.size("starts").alias("n"), F.posexplode("starts")).filter("pos > 0")
    # Only the last start in a record is followed by an end tag.
    page = F.when(F.col("pos") == F.col("n") - 1, F.concat(F.lit(PAGE_START), "col", F.lit(PAGE_END)))
    parsed = F.from_xml(page, RECORD_SCHEMA, {**XML_OPTIONS, "columnNameOfCorruptRecord": REJECTED})
    rows = pages.select("n", "pos", "col", F.inline(F.array(parsed)))
    good = (F.col("pos") == F.col("n") - 1) & F.col(REJECTED).isNull()
    record = F.regexp_replace(F.concat(F.lit(PAGE_START), "col"), r"\s+\z", "")
    return rows.select(
        F.when(good, F.col("title")).alias("title"),
        F.when(good, F.col("ns")).alias("ns"),
        F.when(good, F.col("revision.text._VALUE")).alias("text"),
        F.when(~good, record).alias("reject"),
    )


def scan_dump(spark: SparkSession, path: str, tasks: int | None = None) -> DataFrame:
    """``(title, ns, text)``, one row per page element that can be parsed; see ``scan_dump_records``."""
    return pages_of(scan_dump_records(spark, path, tasks))


def pages_of(records: DataFrame) -> DataFrame:
    return records.filter("reject is null").drop("reject")


def rejects_of(records: DataFrame) -> DataFrame:
    """``(record)``: what starts like a page but cannot be parsed."""
    return records.filter("reject is not null").select(F.col("reject").alias("record"))


def scan_dump_files(spark: SparkSession, path: str) -> DataFrame:
    """The same rows by the XML reader: for dumps that come as many small files."""
    pages = spark.read.format("xml").options(**XML_OPTIONS).schema(PAGE_SCHEMA).load(path)
    return pages.select("title", "ns", F.col("revision.text._VALUE").alias("text"))
