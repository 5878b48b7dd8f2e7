"""Web archives: writing records as WARC files, and reading them back by verified boundaries.

A reader cannot trust the mark that begins a record, as a payload may hold it too. Every piece of
a file that follows a mark is taken as a candidate, which names its successor by its own length.
Pointer jumping from the start of each file then keeps the candidates that the chain of records
reaches, in as many rounds as the logarithm of the records of the longest file.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marginalia.llm.tables import pick
from marginalia.scratch import Scratch

# Fixed values of the format.
MARK = b"WARC/1.0\r\n"
BREAK = b"\r\n\r\n"
RECORDS_PER_FILE = 1000

CANDIDATE = (
    "file string, block long, place long, size long, head long, body long, kind string, page_id long,"
    " refers_to long, digest string, raw binary"
)


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record(page_id: int, url: str, keeper: int | None, digest: str, body: bytes) -> bytes:
    revisit = keeper is not None and keeper != page_id
    head = [
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{page_id}>",
        "WARC-Target-URI: " + re.sub(r"[\r\n]+", " ", url),
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if revisit:
        head += [f"WARC-Refers-To: <urn:page:{keeper}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head.append(f"Content-Length: {0 if revisit else len(body)}")
    return MARK + "\r\n".join(head).encode() + BREAK + (b"" if revisit else body)


def write_warc(pages: DataFrame, path: str, least_bytes: int = 0) -> None:
    """Write ``pages(page_id, url, html)`` as gzip-compressed WARC files below ``path``.

    Of pages with equal payloads of at least ``least_bytes`` the one with the largest id becomes
    a response and the others revisit it, without a payload of their own. Null texts are empty;
    rows without an id are left out. A repeated row is written again as it was.
    """
    full = pages.filter(F.col("page_id").isNotNull()).select(
        "page_id", F.coalesce("url", F.lit("")).alias("url"), F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("body")
    )
    marked = full.withColumn("sha1", F.sha1("body"))
    keepers = (
        marked.filter(F.octet_length("body") >= least_bytes)
        .groupBy("sha1")
        .agg(F.max("page_id").alias("keeper"), F.min("page_id").alias("least"))
        .filter(F.col("least") < F.col("keeper"))
        .select("sha1", "keeper")
    )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "keeper", "sha1", "body")), strict=True)
            records = [
                _record(page, url, keeper, base64.b32encode(bytes.fromhex(sha1)).decode(), body)
                for page, url, keeper, sha1, body in rows
            ]
            yield pa.RecordBatch.from_arrays([pa.array(records, pa.binary()).cast(pa.string())], ["value"])

    joined = marked.join(keepers, "sha1", "left").select("page_id", "url", "keeper", "sha1", "body")
    joined.mapInArrow(build, "value string").write.options(
        lineSep=BREAK.decode(), compression="gzip", maxRecordsPerFile=RECORDS_PER_FILE
    ).text(path)


def _field(head: bytes, name: bytes, pattern: bytes) -> bytes | None:
    found = re.search(rb"(?:^|\r\n)" + name + rb": *" + pattern + rb"(?:\r\n|$)", head)
    return found and found[1]


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per mark. A payload that goes on beyond the next mark is handed on raw, as are
    the pieces that may belong to it; every other one only as its digest."""
    here, at, reach = None, 0, 0
    for batch in batches:
        rows = []
        for file, block, piece in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if (file, block) != here:
                here, at, reach = (file, block), 0, 0
            head, _, rest = piece.partition(BREAK)
            length = _field(head, rb"Content-Length", rb"(\d{1,18})")
            kind = _field(head, rb"WARC-Type", rb"(\w+)") or b""
            page = _field(head, rb"WARC-Record-ID", rb"<urn:page:(-?\d{1,18})>")
            refers = _field(head, rb"WARC-Refers-To", rb"<urn:page:(-?\d{1,18})>")
            body = int(length) if length is not None else None
            whole = body is not None and len(rest) >= body
            digest = base32_sha1(rest[:body]) if whole else None
            raw = piece if at - len(MARK) < reach or (body is not None and not whole) else None
            rows.append((
                file, block, at, len(piece) + len(MARK), len(head) + len(BREAK), body, kind.decode(errors="replace"),
                int(page) if page else None, int(refers) if refers else None, digest, raw,
            ))
            if body is not None:
                reach = max(reach, at + len(head) + len(BREAK) + body)
            at += len(piece) + len(MARK)
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        names = [c.split()[0] for c in CANDIDATE.split(",")]
        columns = zip(*rows, strict=True) if rows else [[] for _ in names]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.option("lineSep", MARK.decode()).text(path)
        .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("piece"))
    )


def candidate_records(spark: SparkSession, path: str) -> DataFrame:
    """Every mark in the files: its byte offset, what follows it, and the offset it points to.

    Spark's line reader cuts the files at the mark, splits included. As each byte lies in one
    piece or in one mark, sums of lengths give the offsets: within a split as it is read, and
    over the splits of a file by a sum of one number each.
    """
    return _pieces(spark, path).mapInArrow(_candidates, CANDIDATE)


def with_offsets(found: DataFrame) -> DataFrame:
    """Add ``offset`` (of the mark) and ``next`` (where the successor should begin)."""
    blocks = found.groupBy("file", "block").agg(F.sum("size").alias("bytes"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("file", "block", F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("start"))
    mark = len(MARK)
    placed = found.join(starts, ["file", "block"]).withColumn("offset", F.col("start") + F.col("place") - mark)
    follows = F.col("offset") + mark + F.col("head") + F.col("body") + len(BREAK)
    return placed.withColumn("next", F.when(F.col("offset") >= 0, follows))


def reachable(chain: DataFrame, scratch: Scratch) -> DataFrame:
    """``(file, offset)`` of the records that the chain from offset 0 of their file reaches.

    ``chain(file, offset, next)``. In round k every pointer spans 2^k records, and the first
    2^k records of each file are known.
    """
    state = scratch.keep(
        chain.select("file", "offset", F.col("next").alias("jump"), (F.col("offset") == 0).alias("reached"), F.lit(False).alias("fresh")),
        "chain",
    )
    while True:
        known = state.filter("reached").select("file", F.col("jump").alias("offset"), F.lit(True).alias("hit")).distinct()
        onward = state.select("file", F.col("offset").alias("jump"), F.col("jump").alias("further"))
        hit = F.coalesce("hit", F.lit(False))
        step = (
            state.drop("fresh").join(known, ["file", "offset"], "left")
            .join(onward, ["file", "jump"], "left")
            .select(
                "file", "offset", F.col("further").alias("jump"),
                (F.col("reached") | hit).alias("reached"), (~F.col("reached") & hit).alias("fresh"),
            )
        )
        before, state = state, scratch.keep(step, "chain")
        scratch.drop(before)
        if state.filter("fresh").isEmpty():
            return state.filter("reached").select("file", "offset")


def _first_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pieces of a split whose marks stand before ``upto`` bytes of it, raw."""
    here, at = None, 0
    for batch in batches:
        rows = []
        for file, block, upto, piece in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if (file, block) != here:
                here, at = (file, block), 0
            if at - len(MARK) < upto:
                rows.append((file, block, at, piece))
            at += len(piece) + len(MARK)
        columns = zip(*rows, strict=True) if rows else [[]] * 4
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["file", "block", "place", "raw"])


def _raw_pieces(spark: SparkSession, path: str, found: DataFrame, kept: DataFrame, scratch: Scratch) -> DataFrame:
    """``(file, offset, head, body, digest, raw)`` of every piece that may belong to an open payload.

    Within a split they were handed on as it was read. Payloads that run on into later splits of
    their file are known by now: the largest open end of the splits before is carried along, one
    number per split, and only where it reaches into a split are the pieces read again.
    """
    ends = F.max(F.when(F.col("real") & F.col("digest").isNull(), F.col("next") - len(BREAK)))
    splits = found.join(kept, ["file", "offset"], "left").groupBy("file", "block").agg(F.first("start").alias("start"), ends.alias("end"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    reached = splits.select("file", "block", (F.max("end").over(earlier) - F.col("start")).alias("upto")).filter("upto > 0")
    reached = scratch.keep(reached, "reached")
    columns = ["file", "offset", "head", "body", "digest", "raw"]
    handed_on = found.filter(F.col("raw").isNotNull()).select(*columns)
    if reached.isEmpty():
        return handed_on
    # Broadcast, one number per split: the pieces of a split stay in their order.
    again = _pieces(spark, path).join(F.broadcast(reached), ["file", "block"]).select("file", "block", "upto", "piece")
    again = again.mapInArrow(_first_pieces, "file string, block long, place long, raw binary")
    missing = found.filter(F.col("raw").isNull()).drop("raw").join(again, ["file", "block", "place"])
    return handed_on.unionByName(missing.select(*columns))


def _join_pieces(rows):
    """The digest of one record's payload that spans several pieces."""
    rows = rows.sort_values("offset")
    first = rows.iloc[0]
    whole = MARK.join(bytes(r) for r in rows["raw"])
    payload = whole[int(first["head"]) :][: int(first["body"])]
    if len(payload) != int(first["body"]):
        raise ValueError(f"{first['file']}: {len(payload)} of {int(first['body'])} bytes of the record at {int(first['owner'])}")
    return rows.iloc[:1][["file", "owner"]].assign(joined=base32_sha1(payload))


def read_warc(spark: SparkSession, path: str, scratch: Scratch) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` of each record.

    Length and digest are of the full payload; a revisit takes them from the record it refers to,
    or nulls if that is not there. Unreachable candidates are no records. An archive without
    records gives no rows; one that ends within a payload is an error.
    """
    found = scratch.keep(with_offsets(candidate_records(spark, path)).drop("size"), "candidates")
    kept = reachable(found.filter("offset >= 0").select("file", "offset", "next"), scratch).withColumn("real", F.lit(True))
    # A piece with no record of its own belongs to the record before it in its file. Only pieces
    # that were handed on raw are looked at, and a file's pieces are bounded by the file.
    before = Window.partitionBy("file").orderBy("offset")
    raw = _raw_pieces(spark, path, found, kept, scratch).join(kept, ["file", "offset"], "left")
    owned = raw.withColumn("owner", F.last(F.when(F.col("real"), F.col("offset")), ignorenulls=True).over(before))
    open_ones = F.sum(F.when(F.col("real") & F.col("digest").isNull(), 1)).over(Window.partitionBy("file", "owner"))
    long = (
        owned.withColumn("open", open_ones).filter((F.col("open") > 0) & F.col("owner").isNotNull())
        .select("file", "owner", "offset", "head", "body", "raw")
        .groupBy("file", "owner").applyInPandas(_join_pieces, "file string, owner long, joined string")
        .withColumnRenamed("owner", "offset")
    )
    records = found.drop("raw").join(kept, ["file", "offset"]).join(long, ["file", "offset"], "left").select(
        "page_id", F.col("body").alias("payload_bytes"), F.coalesce("digest", "joined").alias("payload_digest"),
        F.col("kind").alias("record_type"), "refers_to",
    )
    records = scratch.keep(records, "records")
    full = records.filter("record_type = 'response'").groupBy(F.col("page_id").alias("refers_to")).agg(
        F.max("payload_bytes").alias("payload_bytes"), F.max("payload_digest").alias("payload_digest")
    )
    revisits = records.filter("record_type = 'revisit'").select("page_id", "record_type", "refers_to")
    return records.filter("record_type <> 'revisit'").unionByName(
        revisits.join(full, "refers_to", "left").select(*records.columns)
    )


def archive_pages(pages: DataFrame, scratch: Scratch) -> DataFrame:
    """Write the pages as archives and read them back."""
    path = scratch.file("warc")
    write_warc(pick(pages, page_id="page_id", url="url", html="html"), path)
    return read_warc(pages.sparkSession, path, scratch)
