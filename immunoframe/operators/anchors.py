"""Approximate anchor search at read ends, with rescue on the other strand."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import sequence as S
from ..session import ship_package, spread
from .align import codes

#: Reads that are searched together.
PART = 4000
_MATCH = "anchor_id string, strand string, start int, end int, error double"


def best_ends(reads: list[str], anchor: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each read the least edit distance of the anchor to any stretch, and that stretch (the first one that ends)."""
    n, m = len(reads), len(anchor)
    width = max(map(len, reads), default=0)
    table = np.zeros((n, width), np.uint8)
    for i, r in enumerate(reads):
        table[i, : len(r)] = codes(r)
    a = codes(anchor)
    cost = np.broadcast_to(np.arange(m + 1, dtype=np.int32), (n, m + 1)).copy()
    begin = np.zeros((n, m + 1), np.int32)
    best, start, end = np.full(n, m + 1, np.int32), np.zeros(n, np.int32), np.zeros(n, np.int32)
    for j in range(width):
        base = table[:, j]
        live = base > 0
        new, from_ = np.empty_like(cost), np.empty_like(begin)
        new[:, 0], from_[:, 0] = 0, j + 1
        step = cost[:, :-1] + (a[None, :] != base[:, None])
        for k in range(1, m + 1):
            c, f = step[:, k - 1], begin[:, k - 1]
            skip = cost[:, k] + 1
            better = skip < c
            c, f = np.where(better, skip, c), np.where(better, begin[:, k], f)
            gap = new[:, k - 1] + 1
            better = gap < c
            new[:, k], from_[:, k] = np.where(better, gap, c), np.where(better, from_[:, k - 1], f)
        cost[live], begin[live] = new[live], from_[live]
        wins = live & (cost[:, m] < best)
        best[wins], start[wins], end[wins] = cost[wins, m], begin[wins, m], j + 1
    return best, start, end


def match_anchors(
    reads: DataFrame, anchors: DataFrame, window: int, max_error: float, tail: bool = False, both_strands: bool = True, column: str = "sequence",
) -> DataFrame:
    """reads with anchor_id, strand (+ or -), start, end (0-based, half open, on that strand) and error; null without a match.

    The first (or, with tail, the last) ``window`` bases are searched. The anchor with the least share of
    edits wins, then the earlier one in the list; the reverse strand counts only where the forward one has
    no match. Null and empty reads have none; letters beyond ASCII match nothing. Both strands are tried in one pass. anchors (anchor_id, seq) is a short list and goes along with the code.
    """
    ship_package(reads.sparkSession)
    known = [(r[0], r[1]) for r in anchors.select("anchor_id", "seq").collect()]
    if len(known) > 10_000:
        raise ValueError("anchor lists are short by nature; this one is not")

    def search(part: list[str]) -> list[tuple]:
        found: list[tuple] = [(None, None, None, None)] * len(part)
        least = np.full(len(part), np.inf)
        for name, seq in known:
            d, s, e = best_ends(part, seq)
            error = d / max(len(seq), 1)
            for i in np.flatnonzero((error <= max_error + 1e-12) & (error < least)):
                least[i] = error[i]
                found[i] = (name, int(s[i]), int(e[i]), float(error[i]))
        return found

    def part_of(seq: str) -> tuple[str, int]:
        at = max(len(seq) - window, 0) if tail else 0
        return seq[at : at + window], at

    def one(seqs: list[str]) -> list[tuple]:
        cut = [part_of(s) for s in seqs]
        return [(f[0], f[1] + at, f[2] + at, f[3]) if f[0] is not None else f for f, (_, at) in zip(search([c for c, _ in cut]), cut, strict=True)]

    turn = str.maketrans(S.BASES, S.COMPLEMENTS)

    @F.pandas_udf(_MATCH)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for at in range(0, len(b), PART):
                seqs = b.iloc[at : at + PART].fillna("").tolist()
                hits = [(f[0], "+", *f[1:]) if f[0] is not None else (None,) * 5 for f in one(seqs)]
                if both_strands:
                    open_ = [i for i, f in enumerate(hits) if f[0] is None]
                    for i, f in zip(open_, one([seqs[i].translate(turn)[::-1] for i in open_]), strict=True):
                        if f[0] is not None:
                            hits[i] = (f[0], "-", *f[1:])
                rows += hits
            yield pd.DataFrame(rows, columns=["anchor_id", "strand", "start", "end", "error"])

    return spread(reads).withColumn("_m", run(F.col(column))).select(*reads.columns, "_m.*")


def oriented(matched: DataFrame, column: str = "sequence") -> DataFrame:
    """Reads matched on the reverse strand are turned."""
    return matched.withColumn(column, F.when(F.col("strand") == "-", S.reverse_complement(F.col(column))).otherwise(F.col(column)))


def cut(matched: DataFrame, column: str = "sequence", barcode: bool = False) -> DataFrame:
    """Drops the anchor and what precedes it; with ``barcode`` what precedes it is kept in that column."""
    own = oriented(matched, column)
    if barcode:
        own = own.withColumn("barcode", F.when(F.col("anchor_id").isNotNull(), F.substr(F.col(column), F.lit(1), F.col("start"))))
    return own.withColumn(column, F.when(F.col("anchor_id").isNotNull(), S.cut_front(F.col(column), F.col("end"))).otherwise(F.col(column)))


def tag_split(tagged: DataFrame, values: dict[str, str], column: str = "anchor_id") -> DataFrame:
    """A row for each locus whose value the tag contains (several may match); the rest has a null locus."""
    hits = F.filter(F.array(*[F.when(F.col(column).contains(v), F.lit(k)) for k, v in values.items()]), lambda x: x.isNotNull())
    return tagged.withColumn("locus", F.explode_outer(F.when(F.size(hits) > 0, hits)))
