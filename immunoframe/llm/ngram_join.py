"""N-gram Jaccard join by rare-first prefix filtering, and the groups that its links make.

A document's set holds its distinct 5-word shingles (as 64-bit hashes); documents of fewer
words have one shingle, the whole sequence; without words the set is empty and links with
nothing. Two documents link when 100 * |A & B| >= 80 * |A | B|.

1. One pass over the texts makes a row for each document: set size, a 64-bit name of its set (exact
   copies share it), numbers of shingles in four hash ranges and a parity bit for each of 1,024 hash
   classes. Each task also reports the shingles that it met twice or more within a block of
   BLOCK shingles; summed over all documents, the most frequent MOST_FREQUENT of them get a level.
   Levels only order the shingles (rare first, then by hash): any one order gives the same links.
2. A second pass writes, once for each set, the postings of its prefix: two sets that link
   share a shingle of both prefixes. A posting carries size and position, for the length and positional filters.
3. Postings are sorted by shingle within hash partitions and streamed: what shares its shingle
   with nothing is dropped there, and each other posting is told the first set of its run.
   Shingles of high levels are dealt to several partitions and kept whole.
4. Links are sought in rounds. First every set is paired with the run leader that it meets most often; then, of
   CANDIDATES others in different groups (each shingle shows one of its holders), with the one of the least difference by parities.
   That ties groups of near copies with a pair or two for each set. Last, shingles whose holders still lie in different groups are joined with
   themselves on pairs of different groups. There a pair is made at the first shingle it shares only (as far as the
   PREDECESSORS shingles before tell), and if it passes the length, positional and suffix filters: parity bits bound the
   difference from below, range counts the common part from above. Tested pairs are taken out, so each is verified
   once, on the whole sets. Pairs left out lie within one group already, so no link between groups is lost.

Groups are named by min-label contraction over written tables. Nothing that grows
with the documents reaches the driver (the levels are bounded by MOST_FREQUENT), and all joins are equality
joins whose frequent keys Spark can split (adaptive skew join). Finished tables are deleted as soon as the next stands.

Defined cases: null text counts as empty; null doc_ids take part and are named only by the
smallest known id of their group; rows that share a doc_id are judged one by one; an empty
table gives an empty result; other columns are passed over. The 64-bit names are taken as true: of a thousand million
different sets, two share one with a probability of 3 %.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.components import components as contracted
from .common import bounded_batches, drop_staged, frugal, staged, utf8

WIDTH = 5
SIMILARITY = 80
#: Shingles with a level: a broadcast of 9 bytes each. The bound changes the order of the rest, never the result.
MOST_FREQUENT = 1 << 20
#: Shingles that a task looks at together for repeats.
BLOCK = 1 << 20
#: Occurrences of a shingle from which its postings are dealt to several partitions.
HOT = 20_000
#: Postings that one partition is made for.
PARTITION_ROWS = 1_000_000
#: Names that a task keeps to write copies once; words whose hashes it keeps.
SEEN, WORD_CACHE = 50_000, 100_000
#: Bits of the parity sketch, in longs.
SKETCH = [f"s{k}" for k in range(16)]
#: Longs of the sketch once folded for postings.
FOLDED = [f"f{k}" for k in range(4)]
#: Sets of other groups that a set is compared with by parities in the second round.
CANDIDATES = 6
#: Shared shingles before one that show a pair to have been made already.
PREDECESSORS = 3
#: Rows of ids or names that are broadcast; of more, both sides are shuffled.
BROADCAST_IDS = 1_000_000

_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


class _Words(dict):
    """Word to 64-bit hash; forgets all when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_words = _Words()


def shingles(text: bytes, width: int = WIDTH) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    words = text.lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_words.__getitem__, words), np.uint64, n)
    if n < width:
        return np.array([xxhash.xxh64_intdigest(h.tobytes(), seed=n)], np.uint64)
    with np.errstate(over="ignore"):
        total = np.zeros(n - width + 1, np.uint64)
        for k in range(width):
            total = (total ^ (total >> np.uint64(29))) * _MIX[k] + h[k : n - width + 1 + k]
        total = (total ^ (total >> np.uint64(31))) * _MIX[1]
        total ^= total >> np.uint64(29)
    return np.unique(total)


def set_name(own: np.ndarray) -> int:
    """A 64-bit name of a set, as a signed number."""
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(own.tobytes()))))


def prefix_length(n: np.ndarray | int):
    """Shingles of a set of n of which a linked set must share one."""
    return n - (n * SIMILARITY + 99) // 100 + 1


# --- 1: documents and frequent shingles ---------------------------------------------------------------

def _ranges(own: np.ndarray) -> int:
    """Numbers of shingles in four hash ranges, 16 bits each; -1 (no bound) for sets too large for that."""
    if len(own) > 0x7FFF:
        return -1
    c = np.bincount((own >> np.uint64(62)).astype(np.int64), minlength=4)
    return int(c[0] | c[1] << 16 | c[2] << 32 | c[3] << 48)


def _parities(own: np.ndarray) -> np.ndarray:
    """A bit for each class: whether the set has an odd number of shingles in it."""
    classes = 64 * len(SKETCH)
    odd = np.bincount((own >> np.uint64(20) & np.uint64(classes - 1)).astype(np.int64), minlength=classes) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _scan(docs: DataFrame, key: str, text: str) -> DataFrame:
    """A row for each document (id not null), and rows of shingles that a block holds twice or more (token not null).

    ``mark`` is a hash of the text, with which a document is found again where ids repeat or are missing.
    """
    own = docs.select(F.col(key).alias("doc"), F.xxhash64(text).alias("mark"), F.col(text).alias("_t"))
    doc_type = own.schema["doc"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        arrow = to_arrow_type(doc_type)
        names = ["doc", "mark", "n", "id", "ranges", *SKETCH, "token", "seen"]
        kinds = [arrow, pa.int64(), pa.int32(), pa.int64(), pa.int64(), *[pa.int64()] * len(SKETCH), pa.int64(), pa.int64()]
        block, held, copies = [], 0, set()

        def repeated() -> pa.RecordBatch:
            found, count = np.unique(np.concatenate(block), return_counts=True)
            twice = count > 1
            k = int(twice.sum())
            return pa.RecordBatch.from_arrays([*[pa.nulls(k, x) for x in kinds[:-2]], pa.array(found[twice].view(np.int64)), pa.array(count[twice])], names=names)

        for b in batches:
            n, ids, ranges, bits = [], [], [], []
            for t in utf8(b.column(2)):
                s = shingles(t)
                name = set_name(s)
                n.append(len(s))
                ids.append(name)
                ranges.append(_ranges(s))
                bits.append(_parities(s))
                if len(s) and name not in copies:
                    copies.add(name)
                    block.append(s)
                    held += len(s)
                    if held >= BLOCK:
                        yield repeated()
                        block, held, copies = [], 0, set()
            k = len(n)
            sketch = np.vstack([np.empty((0, len(SKETCH)), np.int64), *bits])
            yield pa.RecordBatch.from_arrays(
                [b.column(0).cast(arrow), b.column(1), pa.array(n, pa.int32()), pa.array(ids, pa.int64()), pa.array(ranges, pa.int64()),
                 *[pa.array(np.ascontiguousarray(sketch[:, i])) for i in range(len(SKETCH))], pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64())], names=names)
        if block:
            yield repeated()

    schema = f"doc {own.dtypes[0][1]}, mark long, n int, id long, ranges long, {', '.join(f'{k} long' for k in SKETCH)}, token long, seen long"
    return own.mapInArrow(frugal(run, _words.clear), schema)


def _levels(scanned: DataFrame) -> tuple[bytes, bytes]:
    """The most frequent shingles (sorted, unsigned) and their levels."""
    summed = scanned.where("token is not null").groupBy("token").agg(F.sum("seen").alias("k"))
    leveled = staged(summed.select("token", F.least(F.lit(255), F.round(8 * F.log2("k"))).cast("int").alias("level")), "levels")
    sizes, total, least = leveled.groupBy("level").count().orderBy(F.desc("level")).collect(), 0, 256  # a row for each level
    for r in sizes:
        total += r["count"]
        if total > MOST_FREQUENT:
            break
        least = r["level"]
    table = leveled.where(F.col("level") >= least).toArrow()
    drop_staged(leveled)
    tokens, levels = table.column("token").to_numpy().view(np.uint64), table.column("level").to_numpy().astype(np.uint8)
    order = np.argsort(tokens)
    return tokens[order].tobytes(), levels[order].tobytes()


# --- 2: postings -------------------------------------------------------------------------------------

_POST = "token long, salt int, id long, n int, pos int"


def _postings(docs: DataFrame, text: str, known) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, levels = (np.frombuffer(x, k) for x, k in zip(known.value, (np.uint64, np.uint8), strict=True))
        seen, hot_level = set(), 8 * np.log2(1 + HOT)
        for b in batches:
            tokens, ids, ns, pos, salt = [], [], [], [], []
            for t in utf8(b.column(0)):
                s = shingles(t)
                if not len(s) or (name := set_name(s)) in seen:
                    continue
                if len(seen) < SEEN:
                    seen.add(name)
                size = len(s)
                p = int(prefix_length(size))
                if len(frequent):
                    at = np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)
                    level = np.where(frequent[at] == s, levels[at], 0).astype(np.uint8)
                    order = np.argsort(level, kind="stable")[:p]
                    s, level = s[order], level[order]
                else:
                    s, level = s[:p], np.zeros(p, np.uint8)
                ways = np.maximum(1, np.rint(2.0 ** ((level - hot_level).clip(0) / 8))).astype(np.int32)
                tokens.append(s)
                ids.append(np.full(p, name, np.int64))
                ns.append(np.full(p, size, np.int32))
                pos.append(np.arange(p, dtype=np.int32))
                salt.append(np.where(level > hot_level, 1 + (name & 0xFFFFFF) % ways, 0).astype(np.int32))
            if tokens:
                own = [np.concatenate(x) for x in (tokens, salt, ids, ns, pos)]
                out = pa.RecordBatch.from_arrays([pa.array(own[0].view(np.int64)), *map(pa.array, own[1:])], names=["token", "salt", "id", "n", "pos"])
                yield from (out.slice(i, 50_000) for i in range(0, out.num_rows, 50_000))

    return docs.select(F.col(text).alias("_t")).mapInArrow(frugal(run, _words.clear), _POST)


# --- 3: shared shingles --------------------------------------------------------------------------------

_LIVE = "token long, id long, n int, pos int, lead long, more boolean"


def _passes(n, m, i, j) -> np.ndarray:
    """Length and positional filter for arrays."""
    need = -(-(n + m) * SIMILARITY // (100 + SIMILARITY))
    return (np.minimum(n, m) * 100 >= np.maximum(n, m) * SIMILARITY) & (np.minimum(i, j) + np.minimum(n - i, m - j) >= need)


def _live(posts: DataFrame, partitions: int) -> DataFrame:
    """Postings that share their shingle, from runs of equal shingles; a set that several tasks wrote counts once.

    ``lead`` is the run's first set where the pair of both passes the filters. ``more`` marks all postings
    of runs of three or more (and of shingles dealt to several partitions), which may hold other pairs too.
    """
    def told(cols: list[np.ndarray], starts: np.ndarray, size: np.ndarray, asked: np.ndarray) -> Iterator[pa.RecordBatch]:
        token, salt, name, n, pos = cols
        run_of = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(token))))
        lead = starts[run_of]
        wide = n.astype(np.int64)
        pair = (lead != np.arange(len(lead))) & _passes(wide, wide[lead], pos, pos[lead])
        more = (size[run_of] > 2) | (salt > 0)
        at = np.flatnonzero(asked & (pair | more))
        leads = pa.array(name[lead[at]], mask=~pair[at])
        out = pa.RecordBatch.from_arrays([*[pa.array(c[at]) for c in (token, name, n, pos)], leads, pa.array(more[at])], names=["token", "id", "n", "pos", "lead", "more"])
        yield from (out.slice(i, 50_000) for i in range(0, out.num_rows, 50_000))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None  # the last run's rows so far: its leader, and the second row while that is all
        big, last = False, None  # whether the held run has shown three rows already; the row before
        for b in batches:
            cols = [c.to_numpy() for c in b.columns]
            if not len(cols[0]):
                continue
            fresh = np.ones(len(cols[0]), bool)
            fresh[1:] = (cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1]) | (cols[2][1:] != cols[2][:-1])
            fresh[0] = last != tuple(int(c[0]) for c in cols[:3])
            last = tuple(int(c[-1]) for c in cols[:3])
            cols = [c[fresh] for c in cols]
            before = len(held[0]) if held is not None else 0
            if before:
                cols = [np.concatenate(x) for x in zip(held, cols, strict=True)]
            token, salt = cols[:2]
            start = np.ones(len(token), bool)
            start[1:] = (token[1:] != token[:-1]) | (salt[1:] != salt[:-1])
            starts = np.flatnonzero(start)
            size = np.diff(np.append(starts, len(token)))
            asked = np.ones(len(token), bool)
            if before and big:
                asked[:before] = False  # given out before
                size[0] += 3
            if size[-1] <= 2:  # may go on in the next batch
                asked[starts[-1] :] = False
            yield from told(cols, starts, size, asked)
            big = bool(size[-1] > 2)
            held = [c[starts[-1] : starts[-1] + 1 if big else len(token)] for c in cols]
        if held is not None and not big:
            yield from told(held, np.zeros(1, np.int64), np.array([len(held[0])]), np.ones(len(held[0]), bool))

    return posts.repartition(partitions, "token", "salt").sortWithinPartitions("token", "salt", "id").mapInArrow(frugal(run), _LIVE)


# --- 4: verified links and groups ------------------------------------------------------------------------

def _may_link(x: str, y: str) -> Column:
    """Length and positional filter and the folded parities for two postings of one shingle, at the first that a pair shares."""
    c = F.col
    n, m, i, j = c(f"{x}.n"), c(f"{y}.n"), c(f"{x}.pos"), c(f"{y}.pos")
    length = F.least(n, m) * 100 >= F.greatest(n, m) * SIMILARITY
    positional = F.least(i, j) + F.least(n - i, m - j) >= _required(n, m)
    new = F.lit(True)
    for k in range(1, PREDECESSORS + 1):
        for h in range(1, PREDECESSORS + 1):
            new = new & ~F.coalesce(c(f"{x}.p{k}") == c(f"{y}.p{h}"), F.lit(False))
    return length & positional & new & (_differing(x, y, FOLDED) * (100 + SIMILARITY) <= (n + m) * (100 - SIMILARITY))


def _required(n: Column, m: Column) -> Column:
    """Least number of shared shingles of linked sets of n and m."""
    return F.ceil((n + m) * SIMILARITY / (100 + SIMILARITY) - 1e-9)


def _differing(x: str, y: str, sketch: list[str]) -> Column:
    """At most as many shingles as are in one of the sets only."""
    out = F.lit(0)
    for s in sketch:
        out = out + F.bit_count(F.col(f"{x}.{s}").bitwiseXOR(F.col(f"{y}.{s}")))
    return out


def _suffix(x: str, y: str) -> Column:
    """Suffix filter on whole sets: bounds of the difference by parities and of the common part by hash ranges."""
    c = F.col
    n, m, common = c(f"{x}.n"), c(f"{y}.n"), F.lit(0)
    for k in range(4):
        part = lambda r, k=k: F.shiftrightunsigned(c(f"{r}.ranges"), 16 * k).bitwiseAND(F.lit(0xFFFF))
        common = common + F.least(part(x), part(y))
    unbounded = (c(f"{x}.ranges") == -1) | (c(f"{y}.ranges") == -1)
    return (_differing(x, y, SKETCH) * (100 + SIMILARITY) <= (n + m) * (100 - SIMILARITY)) & (unbounded | (common >= _required(n, m)))


def _wide(own: np.ndarray) -> bytes:
    """Parities of a set in 8 to 16 hash classes a shingle."""
    classes = max(64, 1 << int(8 * len(own) - 1).bit_length())
    odd = np.bincount((own >> np.uint64(20) & np.uint64(classes - 1)).astype(np.int64), minlength=classes) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _nearly(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs that wide parities leave: nearly those that link, at a sixth of the bytes of the sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            total = (b.column(2).to_numpy() + b.column(3).to_numpy()) * (100 - SIMILARITY)
            good = np.zeros(b.num_rows, bool)
            for i, (u, v) in enumerate(zip(b.column(4).to_pylist(), b.column(5).to_pylist(), strict=True)):
                least = min(len(u), len(v))  # the longer one is folded: its classes fall together by their low bits
                u, v = (np.bitwise_xor.reduce(np.frombuffer(w, np.uint8).reshape(-1, least), axis=0) for w in (u, v))
                good[i] = int(np.bitwise_count(u ^ v).sum()) * (100 + SIMILARITY) <= total[i]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["x", "y"]).filter(pa.array(good))

    of = lambda k: sets.select(F.col("id").alias(k), F.col("n").cast("long").alias(f"{k}n"), F.col("wide").alias(f"{k}w"))
    both = pairs.join(of("x"), "x").join(of("y"), "y").select("x", "y", "xn", "yn", "xw", "yw")
    return both.mapInArrow(frugal(run), "x long, y long")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of the distinct (x, y) the linked ones, by their whole sets."""
    left = sets.select(F.col("id").alias("x"), F.col("s").alias("xs"))
    right = sets.select(F.col("id").alias("y"), F.col("s").alias("ys"))
    both = pairs.join(left, "x").join(right, "y")
    shared = F.size(F.array_intersect("xs", "ys"))
    total = F.size("xs") + F.size("ys")
    return both.where(shared * (100 + SIMILARITY) >= total * SIMILARITY).select("x", "y")


def _facts(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """id, n, ranges and parities of the sets asked for."""
    return rows.where("n > 0").join(ids, "id", "left_semi").select("id", "n", "ranges", *SKETCH).dropDuplicates(["id"])


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("x").alias("id")).unionByName(pairs.select(F.col("y").alias("id"))).distinct()


def _plausible(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """The pairs (x, y and what else they bear) that pass the suffix filter, a staged table, and ``off``, their share of differing parities."""
    pairs = staged(pairs, "pairs", spread=True)
    facts = staged(_facts(rows, _ends(pairs)), "facts")
    c = F.col
    near = pairs.join(facts.alias("a"), c("x") == c("a.id")).join(facts.alias("b"), c("y") == c("b.id")).where(_suffix("a", "b"))
    made = staged(near.select(*pairs.columns, (_differing("a", "b", SKETCH) / (c("a.n") + c("b.n"))).alias("off")), "plausible")
    drop_staged(facts, pairs)
    return made


def _links(pairs: DataFrame, rows: DataFrame, docs: DataFrame, key: str, text: str) -> DataFrame:
    """The linked ones of distinct pairs (x, y), a staged table; only the texts of their ends are read again."""
    whose = rows.where("n > 0").join(_ends(pairs), "id", "left_semi").groupBy("id", "doc").agg(F.count("*").alias("k"))
    whose = staged(whose.groupBy("id").agg(F.min_by(F.struct("doc", "k"), F.struct(F.col("doc").isNull(), "doc")).alias("d")).select("id", "d.doc", "d.k"), "ends")
    sets = staged(_sets(docs, whose, key, text), "sets")
    near = staged(_nearly(pairs, sets), "near", spread=True)
    found = staged(_verified(near, sets.join(_ends(near), "id", "left_semi")), "links", spread=True)
    drop_staged(whose, sets, near)
    return found


def _sets(docs: DataFrame, whose: DataFrame, key: str, text: str) -> DataFrame:
    """id, size, wide parities and shingles, read again from one document of each set asked for."""
    own = docs.select(F.col(key).alias("doc"), F.col(text).alias("_t"))
    ids = whose.where("doc is not null").select("doc").distinct()
    facts = whose.agg(F.count("*").alias("n"), F.coalesce(F.max("k"), F.lit(0)).alias("most"), F.count_if(F.col("doc").isNull()).alias("nameless")).first()
    picked = own.join(_small(ids, facts["n"]), "doc", "left_semi").select("_t")
    if facts["nameless"]:  # sets that only documents without an id have
        picked = picked.unionByName(own.where("doc is null").select("_t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            all_sets = [s for t in utf8(b.column(0)) if len(s := shingles(t))]
            offsets = np.cumsum([0, *map(len, all_sets)]).astype(np.int32)
            flat = np.concatenate([*all_sets, np.empty(0, np.uint64)]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([set_name(s) for s in all_sets], pa.int64()), pa.array(list(map(len, all_sets)), pa.int32()), pa.array(map(_wide, all_sets), pa.binary()),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["id", "n", "wide", "s"])

    made = picked.mapInArrow(frugal(run, _words.clear), "id long, n int, wide binary, s array<long>")
    # only rows that repeat an id and a text, or have no id, can give a set twice
    return made.dropDuplicates(["id"]) if facts["most"] > 1 or facts["nameless"] else made


def _small(ids: DataFrame, n: int) -> DataFrame:
    """ids, broadcast where its counted rows allow."""
    return F.broadcast(ids) if n <= BROADCAST_IDS else ids


def _roots(links: DataFrame) -> DataFrame:
    """id and root of every linked set, a staged table."""
    return staged(contracted(links, "x", "y").select(F.col("node").alias("id"), F.col("component").alias("root")), "roots")


def _favourite(met: DataFrame) -> DataFrame:
    """Of each set (x) the other one that it meets most often, the smaller on a tie."""
    counts = met.groupBy("x", "y").agg(F.count("*").alias("k"))
    return counts.groupBy("x").agg(F.max_by("y", F.struct("k", (-F.col("y")).alias("o"))).alias("y"))


def _open(postings: DataFrame, roots: DataFrame) -> DataFrame:
    """The postings (token, id, n, pos) of shingles whose holders lie in different groups, with root and ``shown``, one of the holders."""
    n = roots.count()
    named = postings.select("token", "id", "n", "pos").join(_small(roots, n), "id", "left").withColumn("root", F.coalesce("root", "id"))
    one = F.min(F.struct(F.xxhash64("token", "id").alias("h"), "id", "n", "root")).alias("shown")
    mixed = named.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), one).where("lo <> hi").select("token", "shown")
    return named.join(mixed, "token")


def _ordered(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("x"), F.greatest(x, y).alias("y")]


def _groups(rows: DataFrame, docs: DataFrame, key: str, text: str, known) -> DataFrame:
    """id and root of all sets that link with another, a staged table."""
    spark, c = docs.sparkSession, F.col
    size = rows.where("n > 0").agg(F.coalesce(F.sum(c("n") * (100 - SIMILARITY) / 100 + 1), F.lit(0)).alias("k")).first()["k"]
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(size // PARTITION_ROWS) + 1)
    live = staged(_live(_postings(docs, text, known), partitions), "live")

    first = staged(_favourite(live.where("lead is not null").select(c("id").alias("x"), c("lead").alias("y"))).select(*_ordered("x", "y")).distinct(), "pairs")
    plausible = _plausible(first, rows)
    links = _links(plausible, rows, docs, key, text)
    drop_staged(plausible)
    roots = _roots(links)

    open_ = staged(_open(live.where("more"), roots), "open")
    shown = c("shown")
    wide = F.least("n", shown["n"]) * 100 >= F.greatest("n", shown["n"]) * SIMILARITY
    met = open_.where((c("root") != shown["root"]) & wide).select(c("id").alias("x"), shown["id"].alias("y"))
    some = met.groupBy("x").agg(F.slice(F.array_sort(F.collect_set(F.struct(F.xxhash64("x", "y").alias("h"), "y"))), 1, CANDIDATES).alias("ys"))
    some = some.select("x", F.explode("ys.y").alias("y"), F.lit(True).alias("one"))
    # runs of two have no other pair than their own: those not yet tested come here, all at once
    two = live.where("not more and lead is not null").select(*_ordered("id", "lead")).distinct()
    n = roots.count()
    of = lambda k: _small(roots.select(c("id").alias(k), c("root").alias(f"{k}_root")), n)
    apart = two.join(of("x"), "x", "left").join(of("y"), "y", "left").where(F.coalesce("x_root", "x") != F.coalesce("y_root", "y")).select("x", "y", F.lit(False).alias("one"))
    old = first.unionByName(first.select(c("y").alias("x"), c("x").alias("y")))
    plausible = _plausible(some.unionByName(apart).join(old, ["x", "y"], "left_anti"), rows)
    best = plausible.where("one").groupBy("x").agg(F.min_by("y", F.struct("off", "y")).alias("y"))
    second = staged(best.unionByName(plausible.where("not one").select("x", "y")).select(*_ordered("x", "y")).distinct(), "pairs")
    links = links.unionByName(_links(second, rows, docs, key, text))
    drop_staged(roots, plausible)
    roots = _roots(links)

    still = staged(_open(open_, roots).drop("shown"), "open")
    drop_staged(open_, live)
    before = W.partitionBy("id").orderBy("pos")
    told = still.select("*", *[F.lag("token", k).over(before).alias(f"p{k}") for k in range(1, PREDECESSORS + 1)])
    fold = lambda k: reduce(Column.bitwiseXOR, [c(SKETCH[k + len(FOLDED) * j]) for j in range(len(SKETCH) // len(FOLDED))])
    folded = [fold(k) for k in range(len(FOLDED))]
    facts = _facts(rows, still.select("id").distinct()).select("id", *[f.alias(name) for f, name in zip(folded, FOLDED, strict=True)])
    sides = staged(told.join(facts, "id"), "sides")
    x, y = sides.alias("x"), sides.alias("y")
    both = x.join(y, c("x.token") == c("y.token")).where((c("x.id") < c("y.id")) & (c("x.root") != c("y.root"))).where(_may_link("x", "y"))
    tested = first.unionByName(second)
    third = _plausible(both.select(c("x.id").alias("x"), c("y.id").alias("y")).distinct().join(tested, ["x", "y"], "left_anti"), rows)
    drop_staged(still, sides, roots, first, second)
    roots = _roots(links.unionByName(_links(third.select("x", "y"), rows, docs, key, text)))
    drop_staged(third)
    return roots


def _named_rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    """The row of each document: doc, mark, n, id and its group's root."""
    spark = docs.sparkSession
    bounded_batches(spark)
    scanned = staged(_scan(docs, key, text), "rows")
    rows = scanned.where("id is not null").drop("token", "seen")
    known = spark.sparkContext.broadcast(_levels(scanned))
    roots = _groups(rows, docs, key, text, known)
    known.unpersist()
    return rows.select("doc", "mark", "n", "id").join(_small(roots, roots.count()), "id", "left").withColumn("root", F.coalesce("root", "id"))


def components(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_shingles and component_id of every row."""
    rows = _named_rows(docs, key, text)
    low = staged(rows.where("n > 0").groupBy("root").agg(F.min("doc").alias("component_id")), "components")
    full = rows.where("n > 0").join(low, "root").select("doc", "n", "component_id")
    empty = rows.where("n = 0").select("doc", "n", F.col("doc").alias("component_id"))
    return full.unionByName(empty).select(F.col("doc").alias(key), F.col("n").cast("long").alias("n_shingles"), "component_id")


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group (that with the smallest id, null ids last), with all columns; wordless rows stay.

    Groups go by their root, so different groups stay apart where they share an id or have none. Rows are found
    again by id and a hash of their text; only those to drop meet the documents.
    """
    rows = _named_rows(docs, key, text).where("n > 0")
    each = rows.groupBy("root", "doc", "mark").agg(F.count("*").alias("k"))
    order = F.struct(F.col("doc").isNull().alias("nameless"), "doc", "mark")
    each = staged(each, "each")
    first = each.groupBy("root").agg(F.min(order).alias("f")).select("root", F.col("f.doc").alias("d"), F.col("f.mark").alias("m"))
    same = each["doc"].eqNullSafe(F.col("d")) & (F.col("mark") == F.col("m"))
    judged = staged(each.join(first, "root").select(F.col("doc").alias("_doc"), F.col("mark").alias("_mark"), same.alias("_kept"), "k").where("k > 1 or not _kept"), "judged")
    found = lambda t: docs[key].eqNullSafe(t["_doc"]) & (F.xxhash64(docs[text]) == t["_mark"])
    sizes = judged.agg(F.count("*").alias("n"), F.count_if("_kept").alias("repeated")).first()
    out = docs.join(_small(judged.select("_doc", "_mark"), sizes["n"]), found(judged), "left_anti")
    if sizes["repeated"]:  # kept, but there several times over
        again = judged.where("_kept").select("_doc", "_mark")
        own = docs.join(_small(again, sizes["repeated"]), found(again), "left_semi")
        name = "_text"
        while name in docs.columns:
            name += "_"
        out = out.unionByName(own.withColumn(name, F.xxhash64(text)).dropDuplicates([key, name]).drop(name))
    return out
