"""Weighted rendezvous (highest random weight) sharding, in built-in functions only.

Every shard draws a number for every key from md5(key ':' shard); the shard with the
highest weighted draw owns the key. A shard added later wins only keys that its own
draw beats, so rows move into it and nowhere else; a heavier shard gets rows in
proportion to its weight. No row is compared with another one, so there is no shuffle
for the assignment; only the narrow (key, size, checksum) rows are shuffled to number
the slots, in buckets of bounded size whose counts give the offsets.

Defined cases: a null key is a key of its own (all such rows share a shard); null text
has size ``overhead`` and a null checksum; empty text has size ``overhead``; repeated
keys share a shard and get slots of their own; an empty table gives an empty result;
other columns of the input are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Rows numbered together in one bucket of a shard.
SLOT_ROWS = 20_000
LEAST_BUCKETS = 8
NULL_KEY = "\x00null"


def key_text(key: Column) -> Column:
    return F.coalesce(key.cast("string"), F.lit(NULL_KEY))


def _draw(key: Column, shard: int) -> Column:
    """52 bits of md5(key ':' shard) as a long."""
    return F.conv(F.substring(F.md5(F.concat(key, F.lit(f":{shard}"))), 1, 13), 16, 10).cast("long")


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The owner (0-based) of the key among len(weights) shards."""
    if not weights or min(weights) <= 0:
        raise ValueError("every shard needs a weight above 0")
    bids = []
    for shard, weight in enumerate(weights):
        draw = _draw(key, shard)
        bid = F.lit(float(weight)) / -F.ln((draw.cast("double") + 0.5) / float(1 << 52))
        bids.append(F.struct(bid.alias("bid"), draw.alias("draw"), F.lit(shard).alias("shard")))
    return (F.array_max(F.array(*bids)) if len(bids) > 1 else bids[0])["shard"].cast("int")


def shard_rows(
    df: DataFrame, key: str, text: str, n_shards: int, weights: Sequence[float] | None = None,
    overhead: int = 8, grow: int = 1,
) -> DataFrame:
    """key, size, text_crc32, law, shard, slot, grown_shard for every row of df.

    ``grown_shard`` is the owner once ``grow`` shards (of weight 1) are added.
    """
    weights = list(weights or [1.0] * n_shards)
    rows = df.count()
    buckets = max(LEAST_BUCKETS, math.ceil(rows / (n_shards * SLOT_ROWS)))
    name = key_text(F.col(key))
    dealt = df.select(
        F.col(key),
        (F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long") + overhead).alias("size"),
        F.crc32(F.col(text).cast("binary")).alias("text_crc32"),
        rendezvous(name, weights).alias("shard"),
        rendezvous(name, weights + [1.0] * grow).alias("grown_shard"),
        (F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("long") % buckets).alias("_bucket"),
    )
    counts = dealt.groupBy("shard", "_bucket").agg(F.count("*").alias("_n"))
    before = counts.select(
        "shard", "_bucket",
        (F.sum("_n").over(W.partitionBy("shard").orderBy("_bucket")) - F.col("_n")).alias("_before"),
    )
    order = W.partitionBy("shard", "_bucket").orderBy(F.col(key).asc_nulls_first(), "text_crc32", "size")
    numbered = dealt.withColumn("_at", F.row_number().over(order) - 1)
    return numbered.join(before, ["shard", "_bucket"]).select(
        key, "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("_before") + F.col("_at")).cast("long").alias("slot"), "grown_shard",
    )
