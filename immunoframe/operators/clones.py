"""Clones: single linkage of junctions within gene and length classes, and their summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import sequence as S
from .components import components
from .consensus import placed


def genes(calls: F.Column) -> F.Column:
    """The distinct genes of a comma-separated list of alleles."""
    return F.array_distinct(F.transform(F.split(calls, ","), lambda c: F.split(F.trim(c), r"\*")[0]))


def assign(airr: DataFrame, threshold: float = 0.1) -> DataFrame:
    """airr with clone_id: rows that share V and J genes and junction length, single-linked at that share of mismatches.

    Rows with several gene calls belong to the classes of each. Pairs are sought among distinct junctions
    only, by pieces that strings within the threshold must share. Rows without junction or calls get null.
    """
    n = F.length("junction")
    own = airr.withColumn("_row", F.concat_ws("\x01", "v_call", "j_call", "junction"))
    known = own.where(F.col("junction").isNotNull() & F.col("v_call").isNotNull() & F.col("j_call").isNotNull())
    node = known.select("_row", "v_call", "j_call", "junction", n.alias("n")).distinct()
    pairs = node.select("_row", "junction", "n", F.explode(genes(F.col("v_call"))).alias("v"), "j_call")
    classed = pairs.select("_row", "junction", "n", "v", F.explode(genes(F.col("j_call"))).alias("j"))
    same = classed.groupBy("v", "j", "junction").agg(F.min("_row").alias("lead"))  # equal junctions hang on one row
    stars = classed.join(same, ["v", "j", "junction"]).select(F.col("_row").alias("x"), F.col("lead").alias("y"))
    cut = same.withColumn("n", F.length("junction")).withColumn("k", F.floor(F.col("n") * threshold).cast("int"))
    # k + 2 pieces, of which two agree wherever at most k positions differ; dealt by position, as junctions begin and end alike
    dealt = cut.where("k > 0").withColumn("pieces", S.interleaved(F.col("junction"), F.col("n"), F.col("k") + 2))
    part = dealt.select("v", "j", "n", "k", "junction", "lead", F.explode(S.two_of(F.col("pieces"))).alias("s")).select("v", "j", "n", "k", "junction", "lead", "s.*")
    a, b = part.alias("a"), part.alias("b")
    keys = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("v", "j", "n", "at", "piece")]
    on = keys[0]
    for k in keys[1:]:
        on = on & k
    near = a.join(b, on).where(F.col("a.junction") < F.col("b.junction")).where(S.hamming(F.col("a.junction"), F.col("b.junction")) <= F.col("a.k"))
    edges = stars.unionByName(near.select(F.col("a.lead").alias("x"), F.col("b.lead").alias("y"))).distinct()
    found = components(edges.where("x <> y"), "x", "y").select(F.col("node").alias("_row"), "component")
    named = own.join(found, "_row", "left")
    label = F.when(F.col("junction").isNotNull() & F.col("v_call").isNotNull() & F.col("j_call").isNotNull(), F.sha1(F.coalesce("component", "_row")))
    return named.withColumn("clone_id", F.substring(label, 1, 12)).select(*airr.columns, "clone_id")


def summary(airr: DataFrame) -> DataFrame:
    """clone_id, molecules, spots, reads and rank (by molecules, then by id)."""
    own = airr.where(F.col("clone_id").isNotNull()).groupBy("clone_id").agg(
        F.count("*").alias("n_molecules"), F.countDistinct("spbcid").alias("n_spbcs"), F.sum("consensus_count").cast("long").alias("n_reads"))
    ranked = placed(own.withColumn("_order", -F.col("n_molecules")), ["_order", "clone_id"], name="_place")  # by ranges, not in one task
    return ranked.withColumn("clone_rank", (F.col("_place") + 1).cast("long")).drop("_order", "_place")


def top(airr: DataFrame, n: int) -> DataFrame:
    """The rows of the n largest clones."""
    largest = summary(airr).orderBy("clone_rank").limit(n).select("clone_id")
    return airr.join(F.broadcast(largest), "clone_id", "left_semi")


def conflicts(rows: DataFrame, molecule: str, clone: str = "clone_id") -> DataFrame:
    """Molecules that are in more than one clone."""
    return rows.groupBy(molecule).agg(F.countDistinct(clone).alias("n_clones")).where("n_clones > 1")


def proportions(rows: DataFrame, by: str) -> DataFrame:
    """n and proportion of each value."""
    counts = rows.groupBy(by).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("_all"))  # one row
    return counts.join(F.broadcast(total)).withColumn("proportion", F.round(F.col("n") / F.col("_all"), 6)).drop("_all")


def rank_buckets(clones: DataFrame, limits: tuple[int, ...] = (1, 3, 10)) -> DataFrame:
    """Molecules in clones of rank up to each limit, and beyond the last."""
    bucket = F.lit(f">{limits[-1]}")
    for k in reversed(limits):
        bucket = F.when(F.col("clone_rank") <= k, f"<={k}").otherwise(bucket)
    return clones.groupBy(bucket.alias("bucket")).agg(F.sum("n_molecules").alias("n_molecules"))


def restore(rows: DataFrame, lookup: DataFrame, prefix: str, key: str = "barcode") -> DataFrame:
    """Clone ids for rows whose key carries a sample prefix."""
    bare = F.regexp_replace(F.col(key), f"^{prefix}_", "")
    return rows.withColumn("_key", bare).join(lookup.withColumnRenamed("barcode", "_key"), "_key", "left").withColumnRenamed("_key", "bare_key")
