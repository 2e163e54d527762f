"""Molecule groups: adaptive length filter, seeded subsample, deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import sequence as S

#: Most reads of a group, the reference's default.
MAX_READS = 999_999
#: Group column of each library, and those it may be set to.
GROUP_FIELDS = {"bulk": ("umi",), "visium": ("spbcumi", "umi"), "visiumhd": ("umispbcid", "umi")}


def group_field(library: str, wanted: str | None = None) -> str:
    allowed = GROUP_FIELDS[library]
    if wanted is None:
        return allowed[0]
    if wanted not in allowed:
        raise ValueError(f"{library} groups by one of {allowed}, not {wanted}")
    return wanted


def adaptive_filter(
    reads: DataFrame, group: str, length: str, order: str, bin_size: int = 100, margin: float = 0.05, min_size: int = 5,
) -> DataFrame:
    """reads with n_orig, n_keep and ``kept``: whether the length lies near its group's commonest length class.

    Groups of min_size reads or more are filtered; of equally common classes the one seen first counts.
    Peaks are found over (group, class) counts that are summed before the shuffle; rows without
    a group go. Reads meet their group's limits in an equality join that Spark may split.
    """
    own = reads.where(F.col(group).isNotNull() & (F.col(group).cast("string") != ""))
    classes = own.groupBy(group, S.length_bin(F.col(length), bin_size).alias("_bin")).agg(F.count("*").alias("_k"), F.min(order).alias("_first"))
    peaks = classes.groupBy(group).agg(F.sum("_k").alias("n_orig"), F.max_by("_bin", F.struct("_k", (-F.col("_first")).alias("f"))).alias("_peak"))
    centre = F.col("_peak") + bin_size // 2
    low = F.greatest(F.lit(1), S.round_half_even(centre - margin * centre))
    high = S.round_half_even(centre + margin * centre)
    limits = peaks.select(group, "n_orig", low.alias("_low"), high.alias("_high"))
    inside = (F.col("n_orig") < min_size) | F.col(length).between(F.col("_low"), F.col("_high"))
    marked = own.join(limits, group).withColumn("kept", inside)
    sizes = marked.where("kept").groupBy(group).agg(F.count("*").alias("n_keep"))
    return marked.drop("_low", "_high").join(sizes, group, "left").withColumn("n_keep", F.coalesce("n_keep", F.lit(0)))


def subsample(reads: DataFrame, group: str, n: int, key: str, seed: int = 1) -> DataFrame:
    """At most n rows of each group, by the order of md5(seed | key): the same rows however they are dealt.

    A hot group is thinned before it meets: each salt of a group keeps its own n first rows, so the
    final window sees a bounded number of them.
    """
    draw = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")))
    own = reads.withColumn("_draw", draw).withColumn("_salt", F.pmod(F.xxhash64(key), F.lit(64)))
    order = [F.col("_draw"), F.col(key)]
    first = own.withColumn("_n", F.row_number().over(W.partitionBy(group, "_salt").orderBy(*order))).where(F.col("_n") <= n)
    last = first.withColumn("_n", F.row_number().over(W.partitionBy(group).orderBy(*order))).where(F.col("_n") <= n)
    return last.drop("_draw", "_salt", "_n")


def first_of_each(rows: DataFrame, by: list[str], order: str) -> DataFrame:
    """The first row of each key, by an aggregate that is summed before the shuffle (no window over a hot key)."""
    rest = [c for c in rows.columns if c not in by]
    picked = rows.groupBy(*by).agg(F.min_by(F.struct(*rest), F.col(order)).alias("_r"))
    return picked.select(*by, *[F.col("_r")[c].alias(c) for c in rest]).select(*rows.columns)
