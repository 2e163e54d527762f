"""Source divergence audit: how far the term shares of the sources of a language lie apart.

Terms are counted with their document frequency in one aggregation. The terms that a language keeps become sparse vectors
(source, count) in source order, and terms of identical vectors are one row with a multiplicity: in real text most terms
are rare and share few vectors. Every pair of sources is evaluated once for each distinct vector (numpy, over
blocks of vectors) and the difference counts as often as the vector has terms; tasks hand on sums of pairs only. The
ranking of terms goes back to the original terms.

Shares are integers: p = 1 + floor(scale * (count + a) / (N + a * V)), in exact arithmetic at any count.

Defined cases: null text, lang and source count as ''; a text without terms still makes its (lang, source) a group; a language
with no kept term has value 0 for each pair and no term rows; a source alone in its language has no pair rows; repeated rows
count as documents of their own; ties rank by the item in UTF-8 order; an empty table gives an empty result; other
columns of the input are not looked at.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import bounded_batches, frugal, staged, utf8

#: A term: ASCII letters and everything beyond ASCII, in lower-cased UTF-8.
TERM = rb"[a-z\x80-\xff]+"
#: Sums (group and term) that a task holds before it hands them on.
HELD = 400_000
#: Documents of its language that a term must occur in.
MIN_DOCS = 30
SCALE = 1_000_000_000
#: Added to every count.
SMOOTH = 5
#: Places of the ranking of terms.
TOP = 50
#: Groups (lang, source) that the audit compares; their numbers go to every task. More is an error, not a sample:
#: the pairs asked for grow with their square.
MAX_GROUPS = 200_000
#: Cells (vectors x sources) that are compared at once.
CELLS = 1 << 20


def share(count: Column, total: Column, kept: Column) -> Column:
    """p of a count in a group whose kept terms sum to ``total``; exact by decimals."""
    over = (count + SMOOTH).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    under = (total + SMOOTH * kept).cast("decimal(25,0)")
    return F.call_function("div", over, under) + 1


def _named(docs: DataFrame) -> DataFrame:
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return docs.select(blank("lang").alias("lang"), blank("source").alias("source"), blank("text").alias("_text"))


def term_counts(named: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences) and docs (documents with the term), summed in the task before the shuffle.

    A task holds at most ``HELD`` sums at a time; what it hands on is added up by the aggregation.
    """
    bounded_batches(named.sparkSession)
    term = re.compile(TERM)

    def rows(held: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(n)), pa.array([source] * len(n)), pa.array(list(n), pa.binary()).cast(pa.string()), pa.array(n.values(), pa.int64()), pa.array([docs[t] for t in n], pa.int64())],
                names=["lang", "source", "term", "n", "docs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0
        for b in batches:
            for lang, source, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), utf8(b.column(2)), strict=True):
                found = term.findall(text.lower())
                if not found:
                    continue
                n, docs = held.setdefault((lang, source), (Counter(), Counter()))
                size -= len(n)
                n.update(found)
                docs.update(set(found))
                size += len(n)
                if size > HELD:
                    yield from rows(held)
                    held, size = {}, 0
        yield from rows(held)

    each = named.select("lang", "source", "_text").mapInArrow(frugal(run), "lang string, source string, term string, n long, docs long")
    return each.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def kept_vectors(counts: DataFrame, min_docs: int) -> DataFrame:
    """lang, term and vector (source, n) of every term that its language keeps."""
    return counts.groupBy("lang", "term").agg(
        F.sort_array(F.collect_list(F.struct("source", "n"))).alias("vector"), F.sum("docs").alias("_docs")).where(F.col("_docs") >= min_docs).drop("_docs")


def _pair_sums(vectors: DataFrame, groups: dict[str, tuple[list[str], list[int], int]]) -> DataFrame:
    """lang, a, b (a before b) and the sum over all kept terms of |p_a - p_b|, once for each distinct vector."""
    bounded_batches(vectors.sparkSession)
    places = {lang: {s: i for i, s in enumerate(names)} for lang, (names, _, _) in groups.items()}

    def shares(lang: str, block: list[list[dict]]) -> np.ndarray:
        names, totals, kept = groups[lang]
        n = np.zeros((len(block), len(names)), object if max((c["n"] for v in block for c in v), default=0) > 1 << 33 else np.int64)
        for i, vector in enumerate(block):
            for c in vector:
                n[i, places[lang][c["source"]]] = c["n"]
        return ((n + SMOOTH) * SCALE // np.array([t + SMOOTH * kept for t in totals], n.dtype) + 1).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            by_lang: dict[str, list[int]] = {}
            for i, lang in enumerate(b.column(0).to_pylist()):
                by_lang.setdefault(lang, []).append(i)
            column, times = b.column(1), np.array(b.column(2).to_pylist(), np.int64)
            for lang, rows in by_lang.items():
                size = len(groups[lang][0])
                total = sums.setdefault(lang, np.zeros((size, size), np.int64))
                step = max(1, CELLS // size)
                for k in range(0, len(rows), step):
                    own = rows[k : k + step]
                    p = shares(lang, column.take(pa.array(own)).to_pylist())
                    for a in range(size - 1):
                        total[a, a + 1 :] += times[own] @ np.abs(p[:, a + 1 :] - p[:, a : a + 1])
        for lang, total in sums.items():
            names = groups[lang][0]
            for a in range(len(names) - 1):
                later = names[a + 1 :]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(later)), pa.array([names[a]] * len(later)), pa.array(later), pa.array(total[a, a + 1 :])], names=["lang", "a", "b", "part_sum"])

    made = vectors.select("lang", "vector", "times").mapInArrow(frugal(run), "lang string, a string, b string, part_sum long")
    return made.groupBy("lang", "a", "b").agg(F.sum("part_sum").alias("value"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value and rank.

    ``pair``: every other source of the language, by the summed difference of shares over all kept terms. ``term``: the
    terms whose share in the source is above that in the language, by the difference, ranks to ``top``.
    """
    named = _named(docs)
    terms = staged(kept_vectors(term_counts(named), min_docs), "divergence-terms")
    vectors = staged(terms.groupBy("lang", "vector").agg(F.count("*").alias("times")), "divergence-vectors")
    totals = vectors.select("lang", "times", F.explode("vector").alias("c")).groupBy("lang", F.col("c.source").alias("source")).agg(F.sum(F.col("c.n") * F.col("times")).alias("total"))
    kept = vectors.groupBy("lang").agg(F.sum("times").alias("kept"))
    groups = named.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(kept, "lang", "left").na.fill(0, ["total", "kept"])
    groups = staged(groups, "divergence-groups")

    found = groups.limit(MAX_GROUPS + 1).collect()
    if len(found) > MAX_GROUPS:
        raise ValueError(f"more than {MAX_GROUPS} groups of language and source")
    of: dict[str, tuple[list[str], list[int], int]] = {}
    for r in sorted(found, key=lambda r: (r.lang, r.source.encode())):
        names, sums, _ = of.setdefault(r.lang, ([], [], r.kept))
        names.append(r.source)
        sums.append(r.total)

    sums = _pair_sums(vectors, of)
    other = groups.select("lang", F.col("source").alias("item"))
    pairs = groups.select("lang", "source").join(other, "lang").where("source <> item").withColumns({"a": F.least("source", "item"), "b": F.greatest("source", "item")})
    pairs = pairs.join(sums, ["lang", "a", "b"], "left").select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).alias("value"))

    whole = groups.groupBy("lang").agg(F.sum("total").alias("whole"))
    each = terms.select("lang", "term", F.aggregate("vector", F.lit(0).cast("long"), lambda s, c: s + c["n"]).alias("_n"), F.explode("vector").alias("c"))
    each = each.select("lang", "term", "_n", F.col("c.source").alias("source"), F.col("c.n").alias("n")).join(groups, ["lang", "source"]).join(whole, "lang")
    p, q = share(F.col("n"), F.col("total"), F.col("kept")), share(F.col("_n"), F.col("whole"), F.col("kept"))
    above = each.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (p - q).alias("value")).where("value > 0")

    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    above = above.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(above)
