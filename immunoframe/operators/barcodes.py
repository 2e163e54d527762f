"""Barcode decoding: exact, fuzzy and multi-window lookups as equality joins on distinct barcodes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import sequence as S


def exact(reads: DataFrame, whitelist: DataFrame, column: str = "spbc") -> DataFrame:
    """reads with the whitelist's columns; ``status`` says whether the barcode is listed.

    Of a barcode that is listed several times the greatest row counts, so no read is multiplied.
    """
    rest = [c for c in whitelist.columns if c != column]
    listed = whitelist.groupBy(column).agg(F.max(F.struct(F.lit(True).alias("_listed"), *rest)).alias("_row"))
    joined = reads.join(listed, column, "left")
    return joined.select(*[c for c in joined.columns if c != "_row"], *[F.col(f"_row.{c}").alias(c) for c in rest], F.when(F.col("_row._listed"), "pass").otherwise("fail").alias("status"))


#: Pieces that a candidate shares at most; fewer mismatches need fewer.
TOGETHER = 3


def closest(observed: DataFrame, whitelist: DataFrame, length: int, allowed: int) -> DataFrame:
    """observed, corrected and distance: the nearest listed barcode within ``allowed`` mismatches.

    Of equally near ones the smallest wins. Both sides are dealt position by position into allowed + t pieces, of which barcodes
    within the limit share t, so candidates come from an equality join on every t pieces. t is 1 for one mismatch, 2 for
    two, else 3: the t pieces hold half of 16 bases, so that few are shared by chance. Only distinct barcodes are compared.
    """
    if allowed >= length:
        raise ValueError(f"as many mismatches allowed as a barcode of {length} has bases")
    seen = observed.select(F.col(observed.columns[0]).alias("observed")).where(F.length("observed") == length).distinct()
    listed = whitelist.select(F.col(whitelist.columns[0]).alias("listed")).where(F.length("listed") == length).distinct()
    together = max(1, min(TOGETHER, allowed, length - allowed))

    def cut(df: DataFrame, c: str) -> DataFrame:
        dealt = df.select(c, S.interleaved(F.col(c), F.lit(length), F.lit(allowed + together)).alias("_p"))
        return dealt.select(c, F.explode(S.some_of(F.col("_p"), allowed + together, together)).alias("s")).select(c, "s.*")

    pairs = cut(seen, "observed").join(cut(listed, "listed"), ["at", "piece"]).select("observed", "listed")
    near = pairs.withColumn("d", S.hamming(F.col("observed"), F.col("listed"))).where(F.col("d") <= allowed)
    best = near.groupBy("observed").agg(F.min(F.struct("d", "listed")).alias("m"))
    return best.select("observed", F.col("m.listed").alias("corrected"), F.col("m.d").alias("distance"))


def allowed_mismatches(length: int, fraction: float) -> int:
    return int(length * fraction)


def visium(reads: DataFrame, whitelist: DataFrame, spbc_length: int = 16, umi_length: int = 12, fraction: float = 0.0) -> DataFrame:
    """spbc, umi, spbcumi, x, y, trimmed sequence and status of each read (barcode, then molecule tag, in front).

    whitelist: spbc, x, y. Fails: ``annotation`` (too short or not listed), ``zero length`` (nothing left).
    """
    n = spbc_length + umi_length
    own = reads.withColumn("raw_spbc", S.window(F.col("sequence"), 0, spbc_length)).withColumn("umi", S.window(F.col("sequence"), spbc_length, umi_length))
    k = allowed_mismatches(spbc_length, fraction)
    if k:
        fixed = closest(own.where(F.length("sequence") >= n).select("raw_spbc"), whitelist.select("spbc"), spbc_length, k)
        own = own.join(fixed.select(F.col("observed").alias("raw_spbc"), F.col("corrected").alias("spbc")), "raw_spbc", "left")
    else:
        own = own.withColumn("spbc", F.col("raw_spbc"))
    known = whitelist.groupBy("spbc").agg(F.max(F.struct("x", "y")).alias("_at"))
    own = own.join(known, "spbc", "left")
    bad = (F.length("sequence") < n) | F.col("_at").isNull()
    out = own.select(
        *reads.columns, F.when(~bad, F.col("spbc")).alias("spbc"), F.when(~bad, F.col("umi")).alias("umi"),
        F.when(~bad, F.concat("spbc", "umi")).alias("spbcumi"), F.when(~bad, F.col("_at.x")).alias("x"), F.when(~bad, F.col("_at.y")).alias("y"),
        F.when(bad, F.lit("annotation")).when(F.length("sequence") == n, F.lit("zero length")).alias("fail_reason"))
    return out.withColumn("trimmed", F.when(F.col("spbc").isNotNull(), S.cut_front(F.col("sequence"), n))).withColumn(
        "status", F.when(F.col("fail_reason").isNull(), "pass").otherwise("fail"))


def hd_index(reads: DataFrame, index: DataFrame, umi_length: int = 9, offsets: Sequence[int] = (0, 1, 2), lengths: Sequence[int] | None = None) -> DataFrame:
    """spbcid, spbc, umi, umispbc, umispbcid, x, y and trimmed sequence by lookups at all offsets and lengths.

    index: raw_spbc, spbc_id, x, y, read_count. A read whose windows hit several ids is ambiguous
    and fails; else the hit with the most reads, then the least offset, then the longest, then the
    smallest barcode is taken.
    """
    sx, sy = S.spatial_xy(F.col("spbc_id"))
    own = index.select(
        F.upper("raw_spbc").alias("raw"), F.col("spbc_id").alias("spbcid"), F.coalesce("x", sx).alias("x"), F.coalesce("y", sy).alias("y"),
        F.coalesce("read_count", F.lit(0)).alias("rc"))
    if lengths is None:
        lengths = sorted(r[0] for r in own.select(F.length("raw")).distinct().collect())  # a handful of lengths
    else:
        own = own.where(F.length("raw").isin(list(lengths)))
    probes = F.array(*[
        F.struct(F.lit(o).alias("off"), F.lit(n).alias("len"), F.upper(S.window(F.col("sequence"), umi_length + o, n)).alias("raw"))
        for o in offsets for n in lengths])
    hits = reads.where(F.length("sequence") >= umi_length + min(offsets) + min(lengths)).select("read_id", F.explode(probes).alias("p")).select("read_id", "p.*")
    # by size alone Spark may broadcast the windows, as they come from a small file, and join all of them in the index's one task
    found = hits.where(F.length("raw") == F.col("len")).join(own.hint("shuffle_hash"), "raw")
    rank = F.struct((-F.col("rc")).alias("a"), "off", (-F.col("len")).alias("b"), "raw")
    one = found.groupBy("read_id").agg(
        F.min_by(F.struct("raw", "spbcid", "x", "y", "off", "len"), rank).alias("h"), F.min("spbcid").alias("lo"), F.max("spbcid").alias("hi"))
    joined = reads.join(one, "read_id", "left")
    ok = F.col("h").isNotNull() & (F.col("lo") == F.col("hi"))
    umi = F.upper(S.window(F.col("sequence"), 0, umi_length))
    end = umi_length + F.col("h.off") + F.col("h.len")
    out = joined.select(
        *reads.columns, F.when(ok, umi).alias("umi"), F.when(ok, F.col("h.raw")).alias("spbc"), F.when(ok, F.col("h.spbcid")).alias("spbcid"),
        F.when(ok, F.concat(umi, F.col("h.raw"))).alias("umispbc"), F.when(ok, F.concat(umi, F.col("h.spbcid"))).alias("umispbcid"),
        F.when(ok, F.col("h.x")).alias("x"), F.when(ok, F.col("h.y")).alias("y"), F.when(ok, S.cut_front(F.col("sequence"), end)).alias("trimmed"),
        F.when(F.col("h").isNull(), F.lit("annotation")).when(~ok, F.lit("ambiguous")).alias("fail_reason"))
    out = out.withColumn("fail_reason", F.coalesce("fail_reason", F.when(F.length("trimmed") == 0, F.lit("zero length"))))
    return out.withColumn("status", F.when(F.col("fail_reason").isNull(), "pass").otherwise("fail"))


#: Lengths of the two halves of an older barcode, in the order tried.
HALVES = ((15, 14), (15, 15), (16, 14), (16, 15))


def hd_halves(reads: DataFrame, first: DataFrame, second: DataFrame, umi_base: int = 9, offsets: Sequence[int] = (0, 1, 2), bins: str = "002um") -> DataFrame:
    """Older two-part barcodes: the first (offset, split) whose halves are in both lists gives x, y and the id.

    first and second: seq, ord. Offset bases belong to the molecule tag here.
    """
    s = F.col("sequence")
    probes = F.array(*[
        F.struct(F.lit(i).alias("rank"), F.lit(umi_base + o).alias("umi_n"), S.window(s, umi_base + o, a).alias("b1"), S.window(s, umi_base + o + a, b).alias("b2"),
                 F.lit(a).alias("n1"), F.lit(b).alias("n2"))
        for i, (o, (a, b)) in enumerate((o, h) for o in offsets for h in HALVES)])
    tried = reads.select("read_id", "sequence", F.explode(probes).alias("p")).select("read_id", "sequence", "p.*")
    tried = tried.where((F.length("b1") == F.col("n1")) & (F.length("b2") == F.col("n2")))
    met = tried.join(first.select(F.col("seq").alias("b1"), F.col("ord").alias("x")), "b1").join(second.select(F.col("seq").alias("b2"), F.col("ord").alias("y")), "b2")
    best = met.groupBy("read_id").agg(F.min_by(F.struct("b1", "b2", "x", "y", "umi_n"), "rank").alias("h"))
    umi = F.substr(s, F.lit(1), F.col("h.umi_n"))
    spbc = F.concat("h.b1", "h.b2")
    out = reads.join(best, "read_id", "left")
    ok = F.col("h").isNotNull()
    return out.select(
        *reads.columns, F.when(ok, umi).alias("umi"), F.col("h.b1").alias("bc1"), F.col("h.b2").alias("bc2"), F.when(ok, spbc).alias("spbc"),
        F.when(ok, F.concat(umi, spbc)).alias("umispbc"), F.col("h.x").alias("x"), F.col("h.y").alias("y"),
        F.when(ok, S.spatial_id(F.col("h.x"), F.col("h.y"), bins)).alias("spbc10x"), F.when(ok, "pass").otherwise("fail").alias("status"))


def trim_umi(reads: DataFrame, length: int, forward: bool = True) -> DataFrame:
    """umi from the tail (or head) of ``barcode``; too short ones go, reads without a barcode stay as they are."""
    umi = S.take_end(F.col("barcode"), length, forward)
    return reads.withColumn("umi", umi).where(F.col("barcode").isNull() | F.col("umi").isNotNull())
