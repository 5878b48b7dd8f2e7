"""Sharding along a Hilbert curve over several metadata columns.

Every column is quantised into cells of about equal numbers of rows, the cells' place on the
curve orders the rows, and runs of that order are the shards. Rows close in all columns share a
shard, so each shard's minimum and maximum of any of the columns are narrow and a reader can skip
shards by any of them. The curve is by J. Skilling, Programming the Hilbert curve, 2004.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from marginalia.llm.tables import numbered, pick
from marginalia.scratch import Scratch

BITS = 6
SHARDS = 24


def curve_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """The place on the curve of each row of ``cells`` (rows × dimensions, values below 2^bits)."""
    x = [cells[:, i].astype(np.int64) for i in range(cells.shape[1])]
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for i in range(len(x)):
            turned = (x[i] >> level) & 1 == 1
            swap = np.where(turned, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(turned, x[0] ^ low, x[0] ^ swap)
            x[i] = x[i] ^ swap
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    flips = np.zeros(len(cells), np.int64)
    for level in range(bits - 1, 0, -1):
        flips = np.where((x[-1] >> level) & 1 == 1, flips ^ ((1 << level) - 1), flips)
    index = np.zeros(len(cells), np.int64)
    for level in range(bits - 1, -1, -1):
        for column in x:
            index = (index << 1) | (((column ^ flips) >> level) & 1)
    return index


def _number(df: DataFrame, name: str) -> Column:
    """An order-preserving number: of a string its first six bytes, null below all."""
    column = F.col(name)
    if isinstance(df.schema[name].dataType, StringType):
        head = F.rpad(F.hex(F.substring(F.encode(column, "UTF-8"), 1, 6)), 12, "0")
        column = F.conv(head, 16, 10)
    return F.coalesce(column.cast("double"), F.lit(-1.0))


def hilbert_index(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> DataFrame:
    """Add ``curve``. The cells' bounds are quantiles over all rows: ``2^bits - 1`` numbers each."""
    if len(columns) * bits > 62:
        raise ValueError("the index has to fit into 62 bits")
    numbers = [_number(df, c).alias(f"_{i}") for i, c in enumerate(columns)]
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    cuts = df.select(*numbers).agg(*[F.percentile_approx(f"_{i}", shares, 10_000) for i in range(len(columns))]).first()

    def cell(number: Column, bounds: list[float]) -> Column:
        steps = F.lit(sorted(set(bounds)))
        return F.size(F.filter(steps, lambda bound: bound < number))

    cells = [cell(n, list(c or [])) for n, c in zip(numbers, cuts, strict=True)]

    @F.pandas_udf("long")
    def on_curve(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series(curve_index(np.stack([p.to_numpy() for p in part], axis=1), bits))

    return df.withColumn("curve", on_curve(*cells))


def hilbert_shards(
    df: DataFrame, key: str, columns: Sequence[str], scratch: Scratch, shards: int = SHARDS, bits: int = BITS
) -> DataFrame:
    """Add ``curve``, ``shard`` and ``slot``: runs of the curve that differ by one row at most.

    The key decides between rows of one cell. A null in a column counts as its lowest value, a
    null key comes first; repeated rows each keep a slot. With fewer rows than shards some
    shards stay empty. Besides the key and the columns only small columns should be passed:
    all of them are sorted.
    """
    indexed = hilbert_index(df, columns, bits)
    rest = [F.xxhash64(*[F.col(c) for c in df.columns])]
    placed, total = numbered(indexed, scratch, F.col("curve"), F.col(key), *rest)
    least, longer = divmod(total, shards)  # the first shards take one row more
    cut = longer * (least + 1)
    place, many = F.col("place"), F.lit(max(least, 1))
    shard = F.when(place < cut, F.floor(place / (least + 1))).otherwise(longer + F.floor((place - cut) / many))
    first = F.when(F.col("shard") <= longer, F.col("shard") * (least + 1)).otherwise(cut + (F.col("shard") - longer) * least)
    return placed.withColumn("shard", shard.cast("int")).withColumn("slot", place - first).drop("place")


def write_shards(placed: DataFrame, path: str) -> None:
    """One folder per shard, in the order of the slots."""
    placed.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def document_shards(documents: DataFrame, scratch: Scratch, shards: int = SHARDS) -> DataFrame:
    """Documents over length, language and source: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    The law is ``rows``. The texts are read once and go no further than their size and checksum.
    Sizes are UTF-8 bytes plus 8; a null text has none and the checksum of the empty text. The
    lowest and highest value of each column in the shard are not needed here: they are in the
    footers of the files that ``write_shards`` makes.
    """
    text = F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")
    rows = pick(documents, doc_id="doc_id", text="text", lang="lang", source="source").select(
        "doc_id", "lang", "source", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    )
    placed = hilbert_shards(rows, "doc_id", ["size", "lang", "source"], scratch, shards)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "curve",
    )
