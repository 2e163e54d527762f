"""Alignment of molecule groups and consensus sequences."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import sequence as S
from ..scratch import staged
from ..session import ship_package


def majority(rows: DataFrame, group: str, *columns: str) -> DataFrame:
    """The commonest value of each column in each group (the larger one on a tie) and its count ``<column>_n``.

    All columns are counted in one aggregation over (group, column, value), summed before the shuffle. Null values
    have no vote; a group without any vote for a column has null there, one without votes at all no row.
    """
    kinds = {c: rows.schema[c].dataType for c in columns}
    votes = F.array(*[F.struct(F.lit(i).alias("at"), *[(F.col(c) if c == d else F.lit(None).cast(kinds[d])).alias(f"v{k}") for k, d in enumerate(columns)]) for i, c in enumerate(columns)])
    names = [f"v{k}" for k in range(len(columns))]
    each = rows.select(F.col(group).alias("_g"), F.explode(votes).alias("s")).select("_g", "s.*").where(" OR ".join(f"{n} IS NOT NULL" for n in names))
    counts = each.groupBy("_g", "at", *names).agg(F.count("*").alias("n"))
    best = counts.groupBy("_g").agg(*[F.max(F.when(F.col("at") == i, F.struct("n", n))).alias(f"_{n}") for i, n in enumerate(names)])
    return best.select(F.col("_g").alias(group), *[x for i, c in enumerate(columns) for x in (F.col(f"_v{i}")[f"v{i}"].alias(c), F.col(f"_v{i}")["n"].alias(f"{c}_n"))])


def consensus(aligned: DataFrame, group: str, column: str = "aligned", max_gap: float = 0.5, max_error: float = 0.2, least: int = 1) -> DataFrame:
    """group, consensus, conscount and error: the commonest base of each column of equally long aligned reads.

    Columns with more than max_gap gaps go; groups of fewer than ``least`` reads or with a
    greater share of mismatches than max_error go. Bases are counted for (group, position, base) before
    the shuffle, so a group's size does not matter; ties go to the smaller base.
    """
    bases = aligned.select(group, F.posexplode(F.split(F.upper(F.col(column)), "")).alias("pos", "base")).where("base <> ''")
    counts = bases.groupBy(group, "pos", "base").agg(F.count("*").alias("n"))
    gap = F.col("base").isin("-", ".")
    columns = counts.groupBy(group, "pos").agg(
        F.sum("n").alias("depth"), F.sum(F.when(gap, F.col("n")).otherwise(0)).alias("gaps"),
        F.max(F.when(~gap, F.struct(F.col("n"), (-F.ascii("base")).alias("a"), F.col("base")))).alias("m"))
    kept = columns.where((F.col("gaps") <= max_gap * F.col("depth")) & F.col("m").isNotNull())
    joined = kept.groupBy(group).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", F.col("m.base").alias("b")))), lambda c: c["b"]), "").alias("consensus"),
        F.sum("depth").alias("_all"), F.sum(F.col("m.n")).alias("_same"))
    sizes = aligned.groupBy(group).agg(F.count("*").alias("conscount"))
    return joined.join(sizes, group).where(F.col("conscount") >= least).select(
        group, "consensus", "conscount", F.round(1 - F.col("_same") / F.col("_all"), 6).alias("error")).where(F.col("error") <= max_error)


def placed(rows: DataFrame, order: list[str], ties: list[F.Column] = (), name: str = "_at") -> DataFrame:
    """rows with their 0-based place in the given order (nulls first).

    The range partitions are written once with their numbers, so that counting them and numbering their rows
    see the same ones however often Spark evaluates the plan. Ranges split a hot key wherever a later column of the order differs.
    """
    parts = staged(rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "numbered", spread=True)
    counts = parts.groupBy("_part").agg(F.count("*").alias("_k"))
    before = counts.select("_part", (F.sum("_k").over(W.orderBy("_part")) - F.col("_k")).alias("_before"))  # a row for each partition
    own = parts.withColumn("_n", F.row_number().over(W.partitionBy("_part").orderBy(*order, *ties)))
    return own.join(F.broadcast(before), "_part").withColumn(name, F.col("_n") + F.col("_before") - 1).drop("_part", "_n", "_before")


def numbered(rows: DataFrame, order: str, prefix: str = "seq") -> DataFrame:
    """sequence_id seq1, seq2, ... by ``order`` (nulls first; equal ones in the order of a hash of the row).

    No row is lost; no rows give none.
    """
    hashed = [F.col(f"`{f.name}`") for f in rows.schema.fields if "map" not in f.dataType.simpleString()]
    return placed(rows, [order], [F.xxhash64(*hashed)]).withColumn("sequence_id", F.concat(F.lit(prefix), (F.col("_at") + 1).cast("string"))).drop("_at")


#: Fields of a consensus header in their order: of all libraries, of the spatial ones, of Visium HD.
HEADER_FIELDS = ("GROUP", "CONSCOUNT", "N_ORIG", "N_KEEP", "UMI")
SPATIAL_FIELDS = ("SPBC", "PRCOUNT", "X", "Y")
HD_FIELDS = ("BC1", "BC2", "SPBC10X", "SPBCID", "UMISPBC")


def with_header(rows: DataFrame, library: str, row_id: str = "sequence_id") -> DataFrame:
    """rows with ``header``: the library's fields that the rows have as columns (lower-case names) and that are not null.

    The barcode comes from ``primer`` where the row has one, else from ``spbc``.
    """
    names = HEADER_FIELDS + (() if library == "bulk" else SPATIAL_FIELDS) + (HD_FIELDS if library == "visiumhd" else ())
    held = {n: F.col(n.lower()) for n in names if n.lower() in rows.columns}
    if "SPBC" in names and "primer" in rows.columns:
        held["SPBC"] = F.coalesce("primer", held["SPBC"]) if "SPBC" in held else F.col("primer")
    return rows.withColumn("header", S.header_of(F.col(row_id), **{n: held[n] for n in names if n in held}))


# --- multiple alignment --------------------------------------------------------------------------------

#: Cells of one table of pairs, most pairs in it, and pairs below which each has its own (long reads).
CELLS = 1 << 24
PAIRS = 1024
FEW = 16
#: A column of a pair: both bases, one of the first or one of the second sequence only.
BOTH, FIRST, SECOND = 1, 2, 3


def pairwise(a: str, b: str, match: int = 2, mismatch: int = -1, gap: int = -2) -> tuple[str, str]:
    """Global alignment of two sequences; letters beyond ASCII are compared as such."""
    return pairwise_all([a], [b], match, mismatch, gap)[0]


def pairwise_all(first: list[str], second: list[str], match: int = 2, mismatch: int = -1, gap: int = -2) -> list[tuple[str, str]]:
    """Global alignments of many pairs; pairs of like length share a table and advance together."""
    out = list(zip(first, second, strict=True))
    order = sorted((i for i, (a, b) in enumerate(out) if a != b), key=lambda i: (len(out[i][0]), len(out[i][1])))
    at = 0
    while at < len(order):
        end, n, m = at, 0, 0
        while end < len(order) and end - at < PAIRS:
            a, b = out[order[end]]
            if end > at and (max(n, len(a)) + 1) * (max(m, len(b)) + 1) * (end - at + 1) > CELLS:
                break
            n, m, end = max(n, len(a)), max(m, len(b)), end + 1
        own = order[at:end]
        for part in [own] if len(own) >= FEW else [[i] for i in own]:
            for i, pair in zip(part, _table([out[i] for i in part], match, mismatch, gap), strict=True):
                out[i] = pair
        at = end
    return out


def _letters(seqs: list[str], width: int) -> np.ndarray:
    table = np.zeros((len(seqs), width), np.uint32)
    for row, s in zip(table, seqs, strict=True):
        row[: len(s)] = np.frombuffer(s.encode("utf-32-le"), np.uint32)
    return table


def _table(pairs: list[tuple[str, str]], match: int, mismatch: int, gap: int) -> list[tuple[str, str]]:
    """Rows of the table are bases of the first sequences, each a step over all pairs; then the ways back, together as well."""
    sizes, widths = (np.array([len(p[k]) for p in pairs]) for k in (0, 1))
    n, m, count = int(sizes.max()), int(widths.max()), len(pairs)
    x, y = _letters([p[0] for p in pairs], n), _letters([p[1] for p in pairs], m)
    kind = np.int16 if 2 * max(abs(match), abs(mismatch), abs(gap)) * (n + m + 2) < 1 << 15 else np.int32
    x_t, y_t = np.ascontiguousarray(x.T), np.ascontiguousarray(y.T)
    came = np.full((n + 1, m + 1, count), SECOND, np.uint8)
    score = np.repeat((gap * np.arange(m + 1)).astype(kind)[:, None], count, axis=1)
    steps = score[1:].copy()
    new, diagonal, up = np.empty_like(score), np.empty_like(steps), np.empty_like(steps)
    for i in range(1, n + 1):
        np.multiply(y_t == x_t[i - 1], kind(match - mismatch), out=diagonal, casting="unsafe")
        diagonal += score[:-1]
        diagonal += kind(mismatch)
        np.add(score[1:], kind(gap), out=up)
        new[0] = gap * i
        np.maximum(diagonal, up, out=new[1:])
        new[1:] -= steps
        if count == 1:  # gaps along the row
            new[:, 0] = np.maximum.accumulate(new[:, 0])
        else:
            for k in range(1, m + 1):
                np.maximum(new[k], new[k - 1], out=new[k])
        new[1:] += steps
        both = (new[1:] == diagonal).view(np.uint8)
        both *= SECOND - BOTH
        np.maximum(both, new[1:] == up, out=both)
        np.subtract(SECOND, both, out=came[i, 1:])
        came[i, 0] = FIRST
        score, new = new, score

    row, at, live, taken = sizes.copy(), widths.copy(), np.arange(count), []
    if count == 1:
        i, j = n, m
        while i or j:
            told = int(came[i, j, 0])
            taken.append((told,))
            i, j = i - (told != SECOND), j - (told != FIRST)
        live = live[:0]
    while len(live):
        told = came[row[live], at[live], live]
        step = np.zeros(count, np.uint8)
        step[live] = told
        taken.append(step)
        row[live] -= told != SECOND
        at[live] -= told != FIRST
        live = live[(row[live] > 0) | (at[live] > 0)]
    way = np.array(taken[::-1], np.uint8).reshape(-1, count).T
    length = (way > 0).sum(axis=1).tolist()
    sides = []
    for letters, other in ((x, SECOND), (y, FIRST)):
        held = (way > 0) & (way != other)
        place = np.maximum(np.cumsum(held, axis=1) - 1, 0)
        padded = letters if letters.shape[1] else np.zeros((count, 1), np.uint32)
        sides.append(np.where(held, np.take_along_axis(padded, place, axis=1), np.uint32(ord("-"))))
    own = lambda line, k: line[len(line) - k :].tobytes().decode("utf-32-le")
    return [(own(a, k), own(b, k)) for a, b, k in zip(*sides, length, strict=True)]


def centre_of(seqs: set[str]) -> str:
    """The middle one by length, then by letters."""
    return sorted(seqs, key=lambda s: (len(s), s))[len(seqs) // 2]


def insertions(c: str) -> list[tuple[int, int]]:
    """Where an aligned centre has gaps: the number of its bases before the run, and the run's length."""
    out, at = [], 0
    if "-" not in c:
        return out
    for run in _RUNS.finditer(c):
        if run[0][0] == "-":
            out.append((at, len(run[0])))
        else:
            at += len(run[0])
    return out


def laid_out(c: str, q: str, profile: dict[int, int]) -> str:
    """The aligned sequence ``q`` with the gaps that the whole group's profile opens before the bases of the centre."""
    own, parts, at, base = dict(insertions(c)), [], 0, 0
    for place in sorted(profile):
        take = place - base
        parts += [q[at : at + take], q[at + take : at + take + own.get(place, 0)], "-" * (profile[place] - own.get(place, 0))]
        at, base = at + take + own.get(place, 0), place
    return "".join([*parts, q[at:]])


def star_alignment(seqs: list[str]) -> list[str]:
    """Centre-star alignment of one small group: all against its centre, gaps merged; null counts as empty."""
    seqs = [s or "" for s in seqs]
    if len({len(s) for s in seqs}) <= 1:
        return list(seqs)
    centre = centre_of(set(seqs))
    distinct = sorted(set(seqs))
    pairs = dict(zip(distinct, pairwise_all([centre] * len(distinct), distinct), strict=True))
    profile: dict[int, int] = {}
    for c, _ in pairs.values():
        for place, run in insertions(c):
            profile[place] = max(profile.get(place, 0), run)
    return [laid_out(*pairs[s], profile) for s in seqs]


def align_groups(reads: DataFrame, group: str, column: str = "sequence") -> DataFrame:
    """reads with ``aligned``: equally long within each group, as :func:`star_alignment` has it.

    Groups of one length need no alignment and stay in the JVM. Of the others every distinct sequence is aligned with its
    group's centre (the middle place of the group in a global order by ranges), the gaps are merged as the greatest run by (group,
    place), and each sequence is laid out by that profile: a group is split over tasks however large it is, and a group's
    own data in a step is its centre and its profile, a few kB. Null groups and null sequences form no group of
    their own: null sequences count as empty, null groups as one group.
    """
    ship_package(reads.sparkSession)
    paired, laid_by = F.pandas_udf(_paired, "c string, q string, places array<struct<place:int,run:int>>"), F.pandas_udf(_laid, "string")
    own = reads.withColumn("_g", F.col(group)).withColumn("_s", F.coalesce(F.col(column), F.lit("")))
    sizes = own.groupBy("_g").agg(F.min(F.length("_s")).alias("_lo"), F.max(F.length("_s")).alias("_hi"))
    mixed = sizes.where("_lo <> _hi").select("_g")
    same = lambda a, b: a["_g"].eqNullSafe(b["_g"])
    plain = own.join(mixed, same(own, mixed), "left_anti").withColumn("aligned", F.col("_s"))
    several = own.join(mixed, same(own, mixed), "left_semi")
    distinct = placed(several.select("_g", F.length("_s").alias("_n_s"), "_s").distinct(), ["_g", "_n_s", "_s"])
    middle = distinct.groupBy("_g").agg((F.min("_at") + F.floor(F.count("*") / 2)).alias("_middle")).select("_middle")
    centres = distinct.join(middle, F.col("_at") == F.col("_middle")).select(F.col("_g").alias("_c"), F.col("_s").alias("_centre"))
    pairs = distinct.join(centres, F.col("_g").eqNullSafe(F.col("_c"))).select("_g", "_s", "_centre")
    made = staged(pairs.withColumn("_p", paired("_centre", "_s")).select("_g", "_s", "_p.*"), "alignment-pairs", spread=True)

    runs = made.select("_g", F.explode("places").alias("r")).groupBy("_g", F.col("r.place").alias("place")).agg(F.max("r.run").alias("run"))
    profile = runs.groupBy(F.col("_g").alias("_c")).agg(F.map_from_entries(F.collect_list(F.struct("place", "run"))).alias("_profile"))
    joined = made.join(profile, F.col("_g").eqNullSafe(F.col("_c")), "left")
    laid = joined.select("_g", "_s", F.when(F.col("_profile").isNull(), F.col("q")).otherwise(laid_by("c", "q", "_profile")).alias("aligned"))
    laid = laid.select(F.col("_g").alias("_h"), F.col("_s").alias("_t"), "aligned")
    done = several.join(laid, F.col("_g").eqNullSafe(F.col("_h")) & (F.col("_s") == F.col("_t")))
    return plain.select(*reads.columns, "aligned").unionByName(done.select(*reads.columns, "aligned"))


_RUNS = re.compile(r"-+|[^-]+")


def _paired(centres: pd.Series, seqs: pd.Series) -> pd.DataFrame:
    """Each sequence aligned with its centre, and the gaps that it opens there."""
    rows = pairwise_all(centres.tolist(), seqs.tolist())
    return pd.DataFrame([(c, q, [{"place": p, "run": n} for p, n in insertions(c)]) for c, q in rows], columns=["c", "q", "places"], dtype=object)


def _laid(centres: pd.Series, seqs: pd.Series, profiles: pd.Series) -> pd.Series:
    return pd.Series([q if p is None else laid_out(c, q, dict(p)) for c, q, p in zip(centres, seqs, profiles, strict=True)], dtype=object)
