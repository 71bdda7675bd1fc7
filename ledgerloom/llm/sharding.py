"""Operator 1: Feistel shuffle and shards.

Every row gets a global row number; a Feistel network over the smallest even
power of two that holds all rows permutes the numbers, and values outside the
table are walked along their cycle until they fall inside. The permuted number
``p`` gives ``shard = p mod shards`` and ``slot = p div shards``, so both can be
computed for any row, and :func:`unpermute` finds the row of a shard's slot.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import checkpoint, crc32_col, prepare

ROUNDS = 6
_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _keys(seed: int) -> np.ndarray:
    return _mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed & (2**63 - 1)))


def _half_bits(n: int) -> int:
    return max(1, (max(n - 1, 1).bit_length() + 1) // 2)


def _once(x: np.ndarray, half: int, keys) -> np.ndarray:
    h, mask = np.uint64(half), np.uint64((1 << half) - 1)
    left, right = x >> h, x & mask
    for k in keys:
        left, right = right, left ^ (_mix(right + k) & mask)
    return (left << h) | right


def _walk(x: np.ndarray, n: int, step) -> np.ndarray:
    out = step(np.asarray(x, dtype=np.uint64))
    while (outside := out >= np.uint64(n)).any():
        out[outside] = step(out[outside])
    return out


def permute(x: np.ndarray, n: int, seed: int) -> np.ndarray:
    """The place of each row number 0 <= x < n in the shuffled order; a bijection on [0, n)."""
    half, keys = _half_bits(n), _keys(seed)
    return _walk(x, n, lambda v: _once(v, half, keys)).astype(np.int64)


def unpermute(x: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Inverse of :func:`permute`: the row number at each shuffled place."""
    half, keys = _half_bits(n), _keys(seed)
    h, mask = np.uint64(half), np.uint64((1 << half) - 1)

    def back(v):
        # the network is its own inverse with halves swapped and round keys reversed
        swapped = ((v & mask) << h) | (v >> h)
        y = _once(swapped, half, keys[::-1])
        return ((y & mask) << h) | (y >> h)

    return _walk(x, n, back).astype(np.int64)


def row_numbers(df: DataFrame, *order: str) -> tuple[DataFrame, int]:
    """df (narrow) with a gapless ``row_number`` from 0 in the order of the given columns, and its rows.

    The rows are range-partitioned, sorted and checkpointed; one count per
    partition gives each partition's offset. No task holds more than its range,
    and rows with equal sort keys are spread by their place in the input.
    """
    n_parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [*order, "_place"]
    ranged = checkpoint(df.withColumn("_place", F.monotonically_increasing_id()).repartitionByRange(n_parts, *keys).sortWithinPartitions(*keys).drop("_place"))
    at = ranged.withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", 33))
    counts = {r["_part"]: r["n"] for r in at.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per partition
    total, offsets = 0, []
    for part in sorted(counts):
        offsets.append((part, total))
        total += counts[part]
    starts = df.sparkSession.createDataFrame(offsets, "_part long, _start long")
    numbered = at.join(F.broadcast(starts), "_part").withColumn("row_number", F.col("_start") + F.col("_at").bitwiseAND((1 << 33) - 1))
    return numbered.drop("_part", "_at", "_start"), total


def shard_documents(df: DataFrame, shards: int, seed: int = 20240229, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns doc_id, size, text_crc32, row_number, position, law, shard, slot, grown_shard.

    Rows are numbered in the order of (doc_id, size, crc32 of the text). The law
    is ``rows``: shard sizes differ by one row at most, slots are gapless.
    A null text has no bytes; null and repeated ids and repeated rows are rows
    like any other; an empty table gives an empty result; other columns are
    ignored.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    prepare(df.sparkSession)
    narrow = df.select(F.col(id_col).alias("doc_id"), (F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)) + 8).cast("long").alias("size"), crc32_col(F.col(text_col)).alias("text_crc32"))
    numbered, n = row_numbers(narrow, "doc_id", "size", "text_crc32")

    @pandas_udf("long")
    def place(row: pd.Series) -> pd.Series:
        return pd.Series(permute(row.to_numpy(), n, seed))

    return numbered.withColumn("position", place("row_number")).select(
        "doc_id",
        "size",
        "text_crc32",
        "row_number",
        "position",
        F.lit("rows").alias("law"),
        (F.col("position") % shards).cast("int").alias("shard"),
        F.floor(F.col("position") / F.lit(shards)).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
