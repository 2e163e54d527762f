"""The commands of a repertoire run as lazy plans: filter, demux, collapse, seqtag, airr, report."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import sequence as S
from ..operators import anchors, barcodes, consensus, filters, groups, vdj
from ..scratch import staged
from ..sources import metadata


@dataclass(frozen=True)
class CollapseParams:
    """Defaults are those that take effect when nothing is set."""

    library: str = "visium"
    window: int = 1200
    error: float = 0.2
    umi_length: int | None = None
    spbc_length: int = 16
    spbc_error: float = 0.0
    offsets: tuple[int, ...] = (0, 1, 2)
    lengths: tuple[int, ...] | None = None
    forward: bool = True
    rescue: bool = True
    min_length: int = -1
    max_length: int = -1
    adaptive: bool = True
    min_group: int = 5
    bin_size: int = 100
    margin: float = 0.05
    least_reads: int = 1
    max_gap: float = 0.5
    max_error: float = 0.2
    max_reads: int = 999_999
    seed: int = 1
    group: str | None = None


def filter_reads(reads: DataFrame, min_quality: float = -1, min_length: int = -1, max_length: int = -1) -> DataFrame:
    return filters.quality_length(reads, min_quality, min_length, max_length)


def demux(reads: DataFrame, anchor_list: DataFrame, window: int = 50, error: float = 0.2) -> DataFrame:
    """reads cut behind their sample anchor, with its id as ``udi`` (null where none matches, so nothing is lost)."""
    return anchors.cut(anchors.match_anchors(reads, anchor_list, window, error)).withColumnRenamed("anchor_id", "udi").drop("start", "end", "error")


def annotate(reads: DataFrame, anchor_list: DataFrame, p: CollapseParams, whitelist: DataFrame | None = None) -> DataFrame:
    """Anchor cut, then barcode and molecule tag by the library's layout; status and fail_reason of every read.

    The anchor search, by far the dearest step, runs once for each read: its result is written, and the look-ups and both
    ways (pass, fail) read that.
    """
    bulk = p.library == "bulk"
    found = anchors.match_anchors(reads, anchor_list, p.window, p.error, both_strands=p.rescue)
    cut = staged(anchors.cut(found, barcode=bulk), "anchored", spread=True)
    hit, lost = cut.where("anchor_id is not null"), cut.where("anchor_id is null")
    drop = ["anchor_id", "strand", "start", "end", "error"]
    hit, lost = hit.drop(*drop), lost.drop(*drop)
    if bulk:
        n = p.umi_length or 12
        own = hit.withColumn("umi", S.take_end(F.col("barcode"), n, p.forward)).withColumn("trimmed", F.col("sequence"))
        own = filters.route(own, annotation=F.col("umi").isNull())
    elif p.library == "visium":
        own = barcodes.visium(hit, whitelist, p.spbc_length, p.umi_length or 12, p.spbc_error)
    else:
        own = barcodes.hd_index(hit, whitelist, p.umi_length or 9, p.offsets, list(p.lengths) if p.lengths else None)
    missed = lost.select("*", F.lit("fail").alias("status"), F.lit("anchor").alias("fail_reason"))
    return own.unionByName(missed, allowMissingColumns=True)


@dataclass(frozen=True)
class Collapsed:
    """What a collapse made: consensus sequences, every read with its status, and the counts for the run's record."""

    sequences: DataFrame
    reads: DataFrame
    counts: dict[str, int]


def collapse_counted(reads: DataFrame, anchor_list: DataFrame, p: CollapseParams, whitelist: DataFrame | None = None) -> Collapsed:
    """Consensus sequences of molecule groups with their voted annotations; reads needs read_id, sequence, read_ord.

    Three tables are written: all reads with their status, the reads that enter the consensus, and the sequences.
    The counts are observed while these are written, so nothing is computed again to count it.
    """
    group = groups.group_field(p.library, p.group)
    seen, held, out = Observation("annotated"), Observation("retained"), Observation("consensus")
    passed, n = F.col("status") == "pass", F.length("trimmed")
    fits = passed & (n >= p.min_length) & ((n <= p.max_length) if p.max_length >= 0 else F.lit(True))
    every = annotate(reads, anchor_list, p, whitelist).observe(
        seen, F.count(F.lit(1)).alias("input_reads"), F.count_if(passed).alias("annotated_reads"), F.count_if(fits).alias("length_filtered_reads"))
    every = staged(every, "annotated")
    done = every.where(fits).drop("sequence").withColumnRenamed("trimmed", "sequence").withColumn("_len", F.length("sequence"))
    sized = groups.adaptive_filter(done, group, "_len", "read_ord", p.bin_size, p.margin, p.min_group if p.adaptive else 1 << 60)
    retained = sized.where("kept").observe(held, F.count(F.lit(1)).alias("retained_group_reads"))
    kept = groups.subsample(retained, group, p.max_reads, "read_id", p.seed)
    kept = staged(groups.first_of_each(kept.drop("_len", "kept"), ["read_id"], "read_ord"), "molecules")
    aligned = consensus.align_groups(kept, group)
    made = consensus.consensus(aligned, group, "aligned", p.max_gap, p.max_error, p.least_reads)
    votes = [c for c in ("n_orig", "n_keep", "umi", "x", "y", "spbc", "spbcid", "umispbc") if c in kept.columns and c != group]
    voted = consensus.majority(kept, group, *votes)
    if "spbc" in votes:
        voted = voted.withColumnRenamed("spbc_n", "prcount")
    voted = voted.drop(*[f"{c}_n" for c in votes])
    first = kept.groupBy(group).agg(F.min("read_ord").alias("_ord"))
    joined = made.join(voted, group, "left").join(first, group).withColumn("group", F.col(group))
    whole = consensus.numbered(joined, "_ord").drop("_ord").withColumnRenamed("consensus", "sequence")
    sequences = staged(whole.observe(out, F.count(F.lit(1)).alias("consensus_sequences")), "consensus")
    counts = {k: int(v) for o in (seen, held, out) for k, v in o.get.items()}
    return Collapsed(sequences, every, counts)


def collapse(reads: DataFrame, anchor_list: DataFrame, p: CollapseParams, whitelist: DataFrame | None = None) -> DataFrame:
    """The consensus sequences of :func:`collapse_counted`."""
    return collapse_counted(reads, anchor_list, p, whitelist).sequences


def collapse_run(
    reads: DataFrame, anchor_list: DataFrame, p: CollapseParams, root: str, out: str, whitelist: DataFrame | None = None, sample: str | None = None,
) -> dict[str, int]:
    """A collapse as a run does it: sequences and failed reads as Parquet under ``out``, and the module's record under ``root``."""
    began = dt.datetime.now(dt.UTC)
    done = collapse_counted(reads, anchor_list, p, whitelist)
    files = {"consensus_fasta": f"{out}/consensus", "failed_spatial_barcodes": f"{out}/failed"}
    done.sequences.write.mode("overwrite").parquet(files["consensus_fasta"])
    done.reads.where("status = 'fail'").write.mode("overwrite").parquet(files["failed_spatial_barcodes"])
    ended = dt.datetime.now(dt.UTC)
    metadata.write_record(
        root, "collapse", sample or "run", done.counts, began.isoformat(), ended.isoformat(), sample=sample, files=files,
        parameters={"library": p.library, "window_length": p.window, "anchor_error": p.error, "seed": p.seed, "adaptive_filter": p.adaptive})
    return done.counts


def seqtag(sequences: DataFrame, anchor_list: DataFrame, window: int = 220, error: float = 0.1, split: dict[str, str] | None = None) -> DataFrame:
    """sequences with ``isotype``: the constant-segment anchor near the tail; with ``split`` also the locus."""
    tagged = anchors.match_anchors(sequences, anchor_list, window, error, tail=True).drop("strand", "start", "end", "error").withColumnRenamed("anchor_id", "isotype")
    return anchors.tag_split(tagged, split, "isotype") if split else tagged


def airr(sequences: DataFrame, germlines: DataFrame, productive: bool = False, heavy_only: bool = False) -> DataFrame:
    table = vdj.to_airr(vdj.annotate(sequences, germlines))
    return filters.productive(table, heavy_only) if productive or heavy_only else table
