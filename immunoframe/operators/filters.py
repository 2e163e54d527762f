"""Row filters of reads and of annotated receptor tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import sequence as S


def quality_length(reads: DataFrame, min_quality: float = -1, min_length: int = -1, max_length: int = -1) -> DataFrame:
    """Reads within the limits; -1 turns a limit off."""
    n = F.length("sequence")
    if min_length >= 0:
        reads = reads.where(n >= min_length)
    if max_length >= 0:
        reads = reads.where(n <= max_length)
    if min_quality >= 0:
        reads = reads.where(S.mean_phred(F.col("quality")) >= min_quality)
    return reads


def read_statistics(reads: DataFrame, column: str = "sequence") -> DataFrame:
    """One row: n_reads, n_bases, mean, least and most length, N50.

    N50 comes from the lengths' histogram, so the window runs over distinct lengths only.
    """
    from pyspark.sql import Window as W

    lengths = reads.groupBy(F.length(column).cast("long").alias("n")).agg(F.count("*").alias("k"))
    whole = W.partitionBy(F.lit(0))
    upto = F.sum(F.col("n") * F.col("k")).over(whole.orderBy(F.desc("n")))
    total = F.sum(F.col("n") * F.col("k")).over(whole)
    marked = lengths.withColumn("half", F.when(upto * 2 >= total, F.col("n")))
    return marked.agg(
        F.sum("k").alias("n_reads"), F.sum(F.col("n") * F.col("k")).alias("n_bases"), F.round(F.sum(F.col("n") * F.col("k")) / F.sum("k"), 6).alias("mean_length"),
        F.min("n").alias("min_length"), F.max("n").alias("max_length"), F.max("half").alias("n50"))


def length_class(n: Column) -> Column:
    """The least length of the class of n: lengths below 128 are classes of their own, others share their first seven binary digits.

    A class is at most 1/64 of its least length wide.
    """
    shift = F.greatest(F.length(F.bin(n)) - 7, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", n.cast("long"), shift), shift)


def read_report(reads: DataFrame, min_quality: float = -1, min_length: int = -1, max_length: int = -1) -> DataFrame:
    """Counts of reads by class of length, whole mean quality and whether the limits keep them: what passes before and after a filter.

    One aggregation in one pass. Tables of several files or runs are merged by adding up n_reads, n_bases and
    quality_milli (sums of mean qualities in thousandths); there are a few thousand rows however many reads. -1
    turns a limit off; null qualities have a class of their own and fail a quality limit.
    """
    n, q = F.length("sequence"), S.mean_phred(F.col("quality"))
    own = reads.select(n.cast("long").alias("n"), q.alias("q"))
    fits = F.lit(True)
    for limit, holds in ((min_length, F.col("n") >= min_length), (max_length, F.col("n") <= max_length), (min_quality, F.coalesce(F.col("q") >= min_quality, F.lit(False)))):
        fits = fits & holds if limit >= 0 else fits
    return own.where("n is not null").groupBy(length_class(F.col("n")).alias("length_class"), F.floor("q").cast("int").alias("quality_class"), fits.alias("passed")).agg(
        F.count("*").alias("n_reads"), F.sum("n").alias("n_bases"), F.sum(F.rint(F.col("q") * 1000).cast("long")).alias("quality_milli"))


def report_statistics(report: DataFrame) -> DataFrame:
    """A row for ``before`` and ``after`` from the classes of :func:`read_report`.

    n_reads, n_bases, mean_length and mean_quality are exact; n50, median_length and median_quality are the least value
    of the class that holds the true one, so lengths are at most 1/64 too small and qualities less than 1.
    """
    from pyspark.sql import Window as W

    staged = report.withColumn("stage", F.explode(F.when(F.col("passed"), F.array(F.lit("before"), F.lit("after"))).otherwise(F.array(F.lit("before")))))
    classes = lambda c: staged.groupBy("stage", F.col(c).alias("c")).agg(F.sum("n_reads").alias("k"), F.sum("n_bases").alias("b"))
    whole = W.partitionBy("stage")

    def reached(df: DataFrame, value: str, order: Column, name: str) -> DataFrame:
        upto, total = F.sum(value).over(whole.orderBy(order)), F.sum(value).over(whole)
        pick = F.max if "n50" in name else F.min
        return df.withColumn("_m", F.when(upto * 2 >= total, F.col("c"))).groupBy("stage").agg(pick("_m").alias(name))

    lengths = classes("length_class")
    sums = staged.groupBy("stage").agg(
        F.sum("n_reads").alias("n_reads"), F.sum("n_bases").alias("n_bases"), F.round(F.sum("n_bases") / F.sum("n_reads"), 6).alias("mean_length"),
        F.round(F.sum("quality_milli") / 1000 / F.sum(F.when(F.col("quality_class").isNotNull(), F.col("n_reads"))), 6).alias("mean_quality"))
    return sums.join(reached(lengths, "b", F.desc("c"), "n50"), "stage").join(reached(lengths, "k", F.asc("c"), "median_length"), "stage").join(
        reached(classes("quality_class").where("c is not null"), "k", F.asc("c"), "median_quality"), "stage", "left")


def tagged(reads: DataFrame, dx: int) -> DataFrame:
    """Simplex (0) or duplex (1) reads."""
    return reads.where(F.col("dx") == dx)


def productive(airr: DataFrame, heavy_only: bool = False) -> DataFrame:
    kept = airr.where("productive")
    return kept.where(F.col("v_call").rlike("IGHV")) if heavy_only else kept


def matches(column: Column, pattern: str) -> Column:
    """Pattern found; a null never matches."""
    return F.coalesce(column.rlike(pattern), F.lit(False))


def downstream_quality(airr: DataFrame, locus: str = "IGH", min_count: int = 2) -> DataFrame:
    """Rows of a locus by constant gene, without poly-T molecules, unclear junctions and rare consensus.

    Null molecules and junctions stay: a pattern that cannot be tested has not been found.
    """
    return airr.where(
        F.col("c_call").isNotNull() & (F.substring("c_call", 1, 3) == locus) & ~matches(F.col("umi"), "T{11}")
        & ~matches(F.col("junction"), "N") & (F.col("consensus_count") >= min_count))


def route(reads: DataFrame, **checks: Column) -> DataFrame:
    """status (pass, fail) and fail_reason: the name of the first check that holds."""
    reason = F.coalesce(*[F.when(c, F.lit(n)) for n, c in checks.items()], F.lit(None).cast("string"))
    return reads.withColumn("fail_reason", reason).withColumn("status", F.when(F.col("fail_reason").isNull(), "pass").otherwise("fail"))


def counters(routed: DataFrame) -> DataFrame:
    """One row: total, passed and failed reads."""
    return routed.agg(F.count("*").alias("total"), F.count_if(F.col("status") == "pass").alias("passed"), F.count_if(F.col("status") == "fail").alias("failed"))
