"""V(D)J annotation against user-supplied germlines, and the AIRR columns that follow from it.

Germlines are few (thousands of alleles) and go to every task with their seeds; reads are not shuffled. In a task, seeds
shared with a read bound the score that an allele can reach, and only alleles that can reach the best are aligned: many
reads and alleles at once (:mod:`.align`), with gaps. Positions of a read follow from the way of its alignment, so an insertion or
deletion moves the junction with it.

Defined cases: null and empty reads, and reads without a V match, have null calls; letters other than A, C, G, T match no seed and
count as mismatches; alleles of equal score are all named, in name order, and the first gives the positions; a
conserved codon that the alignment does not reach, or that is deleted, gives a null junction; no germline of a segment gives null calls
of it; repeated reads give equal rows; no reads give no rows; columns of the reads pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package, spread
from . import align

MAX_GERMLINES = 200_000
#: Reads that are annotated together, at most, and bases of them.
BLOCK = 1024
BASES = 1 << 17
#: Shared seeds, and pairs of a candidate and an allele, of one part.
SHARED = 1 << 20
#: Bases of a seed and least score of a call, by segment.
SEED = {"V": 9, "D": 6, "J": 8, "C": 9}
LEAST = {"V": 12, "D": 8, "J": 9, "C": 12}
_FIELDS = (
    "locus string, v_call string, d_call string, j_call string, c_call string, v_score int, v_identity double, d_identity double, j_identity double, "
    "v_sequence_start int, v_sequence_end int, v_germline_start int, v_germline_end int, d_sequence_start int, d_sequence_end int, "
    "d_germline_start int, d_germline_end int, j_sequence_start int, j_sequence_end int, j_germline_start int, j_germline_end int, "
    "v_cigar string, d_cigar string, j_cigar string, junction_start int, junction_end int, rev_comp boolean, "
    "v_row string, v_germline string, d_row string, d_germline string, j_row string, j_germline string")
_NAMES = [x.split()[0] for x in _FIELDS.split(", ")]
#: Fixed value: the standard genetic code, bases in the order TCAG.
AMINO_ACIDS = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
#: Columns of the IMGT unique numbering of V regions, first and last nucleotide.
REGIONS = {"fwr1": (1, 78), "cdr1": (79, 114), "fwr2": (115, 165), "cdr2": (166, 195), "fwr3": (196, 312)}
_TURN = str.maketrans("ACGTN", "TGCAN")


class Hit(NamedTuple):
    """The best alignment of a read with a segment: alleles, path, and where the searched part of the read begins."""

    alleles: list[int]
    score: int
    found: align.Alignments
    at: int
    offset: int

    @property
    def start(self) -> int:
        return self.offset + int(self.found.query_start[self.at])

    @property
    def end(self) -> int:
        return self.offset + int(self.found.query_end[self.at])

    def partner(self, position: int) -> int | None:
        """The read base that stands at a germline position."""
        to = self.found.partners[self.at]
        if 0 <= position < len(to) and to[position] >= 0:
            return self.offset + int(to[position])
        return None


class Part(NamedTuple):
    """Some candidates in a row: the most seeds of an allele and which has them, what each allele can score at most; (candidate, allele) and diagonal of every shared seed."""

    first: int
    votes: np.ndarray
    lead: np.ndarray
    bound: np.ndarray
    pair: np.ndarray
    diagonal: np.ndarray


class Index:
    """Germlines of one segment: allele, locus, sequence, anchor, gapped sequence; and the places of their seeds."""

    def __init__(self, rows: list[tuple], k: int, least: int):
        self.rows, self.k, self.least = sorted(rows, key=lambda r: r[0]), k, least
        self.refs = [align.codes(r[2]) for r in self.rows]
        self.sizes = np.array([len(r) for r in self.refs], np.int64)
        seeds = [self._seeds(r) for r in self.refs]
        code = np.concatenate([np.empty(0, np.int64), *seeds])
        owner = np.repeat(np.arange(len(seeds)), [len(s) for s in seeds])
        place = np.concatenate([np.empty(0, np.int64), *(np.arange(len(s)) for s in seeds)])
        order = np.argsort(code, kind="stable")
        order = order[np.searchsorted(code[order], 0) :]  # without those of other letters
        self.owner, self.place = owner[order], place[order]
        self.first = np.searchsorted(code[order], np.arange((1 << 2 * k) + 1))
        self._columns: dict[int, tuple[str, np.ndarray]] = {}

    def _seeds(self, seq: np.ndarray) -> np.ndarray:
        """The number of the seed at each position, -1 where it has another letter."""
        digit = np.full(256, -1, np.int64)
        digit[list(b"ACGT")] = range(4)
        base, n = digit[seq], len(seq) - self.k + 1
        if n <= 0:
            return np.empty(0, np.int64)
        code, bad, width = np.maximum(base, 0), base < 0, 1
        while 2 * width <= self.k:  # of two windows one of twice the width
            code, bad, width = code[:-width] * 4**width + code[width:], bad[:-width] | bad[width:], 2 * width
        rest = self.k - width
        if rest:
            code, bad = code[:n] * 4**rest + code[rest:] % 4**rest, bad[:n] | bad[rest:]
        return np.where(bad, -1, code)

    def parts(self, bases: list[np.ndarray]) -> Iterator[Part]:
        """The seeds that candidates share with alleles, a few candidates at a time."""
        sizes = np.array([len(x) for x in bases], np.int64)
        begin = np.cumsum(sizes) - sizes
        code = self._seeds(np.concatenate([np.empty(0, np.uint8), *bases]))
        cand = np.repeat(np.arange(len(bases)), sizes)[: len(code)]
        offset = np.arange(len(code)) - begin[cand]
        at = np.flatnonzero((code >= 0) & (offset + self.k <= sizes[cand]))
        low = self.first[code[at]]
        count = self.first[code[at] + 1] - low
        at, low, count = at[count > 0], low[count > 0], count[count > 0]
        cand, offset = cand[at], offset[at]
        upto = np.concatenate([[0], np.cumsum(count)])
        edge = np.searchsorted(cand, np.arange(len(bases) + 1))  # where the seeds of each candidate begin
        some, first = max(1, SHARED // len(self.rows)), 0
        while first < len(bases):
            last = int(np.searchsorted(upto[edge], upto[edge[first]] + SHARED, "right")) - 1
            last = min(max(last, first + 1), first + some, len(bases))
            own = slice(edge[first], edge[last])
            total = int(upto[edge[last]] - upto[edge[first]])
            which = np.repeat(low[own] - (upto[edge[first] : edge[last]] - upto[edge[first]]), count[own]) + np.arange(total)
            pair = np.repeat((cand[own] - first) * len(self.rows), count[own]) + self.owner[which]
            diagonal = np.repeat(offset[own], count[own]) - self.place[which]
            votes = np.bincount(pair, minlength=(last - first) * len(self.rows)).reshape(-1, len(self.rows))
            yield Part(first, votes.max(axis=1), votes.argmax(axis=1), self.bounds(votes, sizes[first:last, None]).astype(np.int32), pair.astype(np.int32), diagonal.astype(np.int32))
            first = last

    def bounds(self, votes: np.ndarray, length: int | np.ndarray) -> np.ndarray:
        """The most that an alignment with an allele can score, given their shared seeds.

        E errors (each costs 2 at least and takes a base) leave E + 1 runs of matches, each at most k - 1 longer than its
        seeds' number: a score of votes + (k - 1) (E + 1) - 2 E at most, and of length - 3 E at most.
        """
        size, k = np.minimum(self.sizes, length), self.k
        e = np.maximum(0, (size - votes - k + 1) // k)
        most = np.maximum(*(np.minimum(votes + (k - 1) * (x + 1) - 2 * x, size - 3 * x) for x in (e, e + 1)))
        return np.where(votes > 0, most, 0)

    def best(self, reads: list[list[tuple[int, np.ndarray]]]) -> list[tuple[int, Hit] | None]:
        """For each read, given as its candidates (offset, bases), the number of the winning candidate and its hit.

        One allele of the most seeds is aligned first; then all that can still reach its score.
        """
        out: list[tuple[int, Hit] | None] = [None] * len(reads)
        read = np.array([r for r, some in enumerate(reads) for _ in some], np.int64)
        if not self.rows or not len(read):
            return out
        number = [c for some in reads for c in range(len(some))]
        offsets, bases = [o for some in reads for o, _ in some], [x for some in reads for _, x in some]
        parts = list(self.parts(bases))
        votes, lead = np.concatenate([p.votes for p in parts]), np.concatenate([p.lead for p in parts])
        order = np.lexsort((np.arange(len(read)), -votes, read))
        order = order[np.concatenate([[True], read[order[1:]] != read[order[:-1]]])]
        chosen = np.sort(order[votes[order] > 0])  # of each read the candidate of the most seeds
        wanted = [self._within(p, chosen) for p in parts]
        jobs = self._jobs(parts, [(c - p.first) * len(self.rows) + lead[c] for p, c in zip(parts, wanted, strict=True)])
        begun = self._aligned(bases, jobs, True)
        top = np.full(len(reads), self.least)
        top[read[jobs[0]]] = np.maximum(begun.score, self.least)
        able = []
        for p, c in zip(parts, wanted, strict=True):
            can = p.bound >= top[read[p.first : p.first + len(p.bound)], None]
            can[c - p.first, lead[c]] = False
            able.append(np.flatnonzero(can))
        more = self._jobs(parts, able)
        cand, allele, diagonal, seeds = (np.concatenate(x) for x in zip(jobs, more, strict=True))
        score = np.concatenate([begun.score, self._aligned(bases, more, False).score])

        rank = np.lexsort((allele, cand, -score, read[cand]))  # the first candidate, alleles in name order
        rank = rank[score[rank] >= self.least]
        if not len(rank):
            return out
        fresh = np.concatenate([[True], read[cand[rank[1:]]] != read[cand[rank[:-1]]]])
        other = fresh | np.concatenate([[True], (score[rank[1:]] != score[rank[:-1]]) | (cand[rank[1:]] != cand[rank[:-1]])])
        first, ends = np.flatnonzero(fresh), np.append(np.flatnonzero(other), len(rank))
        last = ends[np.searchsorted(ends, first, "right")]
        won = rank[first]
        late = won[won >= len(begun.score)]
        again = self._aligned(bases, (cand[late], allele[late], diagonal[late], seeds[late]), True)
        place = {w: i for i, w in enumerate(late.tolist())}
        alleles = allele[rank].tolist()
        for w, c, s, lo, hi in zip(won.tolist(), cand[won].tolist(), score[won].tolist(), first.tolist(), last.tolist(), strict=True):
            out[read[c]] = (number[c], Hit(alleles[lo:hi], s, *((again, place[w]) if w in place else (begun, w)), offsets[c]))
        return out

    def _within(self, part: Part, cands: np.ndarray) -> np.ndarray:
        return cands[(cands >= part.first) & (cands < part.first + len(part.bound))]

    def _jobs(self, parts: list[Part], wanted: list[np.ndarray]) -> tuple[np.ndarray, ...]:
        """Candidate, allele, main diagonal and its number of seeds of the wanted (candidate, allele) pairs of each part."""
        made = [(p.first + w // len(self.rows), w % len(self.rows), *self._main(p, w)) for p, w in zip(parts, wanted, strict=True)]
        return tuple(np.concatenate([np.empty(0, np.int64), *x]) for x in zip(*made, strict=True))

    def _main(self, part: Part, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The diagonal with the most shared seeds of each pair, the least of equal ones, and their number."""
        if not len(wanted):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        which = np.full(part.bound.size, -1, np.int32)
        which[wanted] = np.arange(len(wanted))
        owner = which[part.pair]
        own = owner >= 0
        diagonal = part.diagonal[own].astype(np.int64)
        shift = int(diagonal.min())
        width = int(diagonal.max()) - shift + 1
        key, count = np.unique(owner[own] * width + (diagonal - shift), return_counts=True)
        owners = key // width
        first = np.flatnonzero(np.concatenate([[True], owners[1:] != owners[:-1]]))
        most = np.flatnonzero(count == np.maximum.reduceat(count, first)[owners])
        most = most[np.concatenate([[True], owners[most[1:]] != owners[most[:-1]]])]
        return key[most] % width + shift, count[most]

    def _aligned(self, bases: list[np.ndarray], jobs: tuple[np.ndarray, ...], paths: bool) -> align.Alignments:
        """Alleles that lie whole in the candidate have all their seeds on one diagonal and need no table."""
        cand, allele, diagonal, seeds = jobs
        size = self.sizes[allele]
        whole = seeds == size - self.k + 1
        rest = np.flatnonzero(~whole)
        found = align.local([bases[c] for c in cand[rest].tolist()], [self.refs[g] for g in allele[rest].tolist()], diagonal[rest], paths=paths)
        zero = np.zeros(len(cand), np.int64)
        made = align.Alignments(*(np.where(whole, x, 0) for x in (size, zero, size, diagonal, diagonal + size, size, size)), [None] * len(cand))
        for all_, some in zip(made[:7], found[:7], strict=True):
            all_[rest] = some
        for i, x in zip(rest.tolist(), found.partners, strict=True):
            made.partners[i] = x
        for i in np.flatnonzero(whole).tolist():
            made.partners[i] = np.arange(diagonal[i], diagonal[i] + size[i], dtype=np.int32)
        return made

    def numbering(self, g: int) -> tuple[str, np.ndarray]:
        """An allele in its own numbering, and the column of each of its bases."""
        if g not in self._columns:
            whole = align.codes(self.rows[g][4])
            held = np.flatnonzero(whole != ord("."))
            if len(held) != len(self.rows[g][2]):
                raise ValueError("a gapped germline has other bases than its sequence")
            self._columns[g] = whole.tobytes().decode(), held
        return self._columns[g]


def annotate(reads: DataFrame, germlines: DataFrame, column: str = "sequence") -> DataFrame:
    """reads with gene calls, positions (1-based), cigars and the aligned rows of each segment.

    germlines: allele, locus, segment (V, D, J, C), seq, anchor and, where the IMGT regions are wanted, gapped (the V sequence with
    its dots). anchor is the 0-based germline position of the conserved codon that begins (V) or ends (J) the
    junction. The best gapped local alignment decides; the strand with the better V match counts, the given one
    where both are equal. J is searched behind V, D between them, C behind J. The germline set is bounded and checked.
    """
    ship_package(reads.sparkSession)
    gapped = F.col("gapped") if "gapped" in germlines.columns else F.lit(None).cast("string")
    rows = [tuple(r) for r in germlines.select("allele", "locus", "segment", "seq", "anchor", gapped).limit(MAX_GERMLINES + 1).collect()]
    if len(rows) > MAX_GERMLINES:
        raise ValueError(f"more than {MAX_GERMLINES} germlines")

    @F.pandas_udf(_FIELDS)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        index = index_of(rows)
        for b in batches:
            own = [(s or "").upper() for s in b]
            yield pd.concat([_frame(call(own[lo:hi], index)) for lo, hi in blocks(own, index)]) if own else _frame(call([], index))

    return spread(reads).withColumn("_c", run(F.col(column))).select(*reads.columns, "_c.*")


def index_of(rows: list[tuple]) -> dict[str, Index]:
    """An index for each segment from (allele, locus, segment, seq, anchor, gapped)."""
    return {s: Index([(a, lo, q.upper(), None if n is None or n != n else int(n), x and x.upper()) for a, lo, seg, q, n, x in rows if seg == s], SEED[s], LEAST[s]) for s in "VDJC"}


def blocks(reads: list[str], index: dict[str, Index]) -> list[tuple[int, int]]:
    """Begin and end of the stretches of reads that are annotated together."""
    most = max(1, min(BLOCK, 16 * SHARED // max(1, *(len(x.rows) for x in index.values()))))
    edges, bases = [0], 0
    for i, s in enumerate(reads):
        bases += len(s)
        if i > edges[-1] and (bases > BASES or i - edges[-1] == most):
            edges.append(i)
            bases = len(s)
    return list(zip(edges, [*edges[1:], len(reads)], strict=True))


def _frame(columns: dict[str, list]) -> pd.DataFrame:
    made = {}
    for name, kind in (x.split() for x in _FIELDS.split(", ")):
        if kind == "int":
            held = np.array([x is not None for x in columns[name]], bool)
            made[name] = pd.arrays.IntegerArray(np.array([x or 0 for x in columns[name]], np.int32), ~held)
        else:
            made[name] = np.array(columns[name], np.float64 if kind == "double" else object)
    return pd.DataFrame(made)


def call(reads: list[str], index: dict[str, Index]) -> dict[str, list]:
    """The fields of the reads."""
    both = [(s, s.translate(_TURN)[::-1]) for s in reads]
    coded = [[align.codes(x) for x in pair] if pair[0] else [] for pair in both]
    v = index["V"].best([[(0, x) for x in pair] for pair in coded])
    own = [both[r][hit[0]] if hit else "" for r, hit in enumerate(v)]
    bases = [coded[r][hit[0]] if hit else None for r, hit in enumerate(v)]

    def behind(segment: str, start: list[int], end: list[int]) -> list[Hit | None]:
        parts = [[(a, bases[r][a:b])] if v[r] and b > a else [] for r, (a, b) in enumerate(zip(start, end, strict=True))]
        return [hit and hit[1] for hit in index[segment].best(parts)]

    v_end, size = [hit[1].end if hit else 0 for hit in v], [len(s) for s in own]
    j = behind("J", v_end, size)
    d = behind("D", v_end, [hit.start if hit else n for hit, n in zip(j, size, strict=True)])
    c = behind("C", [hit.end if hit else e for hit, e in zip(j, v_end, strict=True)], size)
    out: dict[str, list] = {n: [None] * len(reads) for n in _NAMES}
    for r, hit in enumerate(v):
        if hit:
            out["rev_comp"][r], out["locus"][r], out["v_score"][r] = bool(hit[0]), index["V"].rows[hit[1].alleles[0]][1], hit[1].score
            for segment, x in (("V", hit[1]), ("D", d[r]), ("J", j[r]), ("C", c[r])):
                if x is not None:
                    _fill(out, r, own[r], segment, index[segment], x)
    return out


def _fill(out: dict[str, list], r: int, read: str, segment: str, index: Index, hit: Hit) -> None:
    """The fields of a read that one segment gives."""
    s, a, p = segment.lower(), hit.found, hit.at
    out[f"{s}_call"][r] = ",".join([index.rows[g][0] for g in hit.alleles])
    if segment == "C":
        return
    start, end, first, last = hit.start, hit.end, int(a.ref_start[p]), int(a.ref_end[p])
    _, _, seq, anchor, gapped = index.rows[hit.alleles[0]]
    runs = align.runs(a, p)
    out[f"{s}_identity"][r] = float(a.matches[p] / a.columns[p])
    out[f"{s}_sequence_start"][r], out[f"{s}_sequence_end"][r], out[f"{s}_germline_start"][r], out[f"{s}_germline_end"][r] = start + 1, end, first + 1, last
    out[f"{s}_cigar"][r] = align.joined(runs, start, first, len(read) - end)
    if segment == "V":
        out["v_row"][r], out["v_germline"][r] = _numbered_rows(read, seq, gapped and index.numbering(hit.alleles[0]), start, first, last, runs)
        place = None if anchor is None else hit.partner(anchor)
        out["junction_start"][r] = None if place is None else place + 1
    else:
        out[f"{s}_row"][r], out[f"{s}_germline"][r] = _rows(read, seq, start, first, runs)
        if segment == "J":
            place = None if anchor is None else hit.partner(anchor + 2)
            out["junction_end"][r] = None if place is None else place + 1


def _numbered_rows(read: str, seq: str, numbering: tuple[str, np.ndarray] | None, start: int, first: int, last: int, runs: list[tuple[int, str]]) -> tuple[str, str]:
    """The read and the V germline in the germline's own numbering, up to the end of the alignment.

    Insertions of the read have no column there and are left out, deletions are '-'; '.' stands for columns that the
    allele lacks or that lie before the alignment.
    """
    parts, at = ["." * first], start
    for n, kind in runs:
        if kind == "D":
            parts.append("-" * n)
        else:
            parts.append(read[at : at + n] if kind == "M" else "")
            at += n
    row = align.codes("".join(parts))
    if numbering is None:
        return row.tobytes().decode(), align.codes(seq[:last]).tobytes().decode()
    whole, held = numbering
    stop = int(held[last - 1]) + 1
    spaced = np.full(stop, ord("."), np.uint8)
    spaced[held[:last]] = row
    return spaced.tobytes().decode(), whole[:stop]


def _rows(read: str, seq: str, start: int, first: int, runs: list[tuple[int, str]]) -> tuple[str, str]:
    """The aligned stretches of read and germline, '-' for a base without partner."""
    own, other, at, to = [], [], start, first
    for n, kind in runs:
        own.append("-" * n if kind == "D" else read[at : at + n])
        other.append("-" * n if kind == "I" else seq[to : to + n])
        at, to = at + n * (kind != "D"), to + n * (kind != "I")
    return "".join(own), "".join(other)


def translate(seq: F.Column) -> F.Column:
    """Amino acids of whole codons; X where a codon has other letters."""
    codes = F.create_map(*[F.lit(x) for i, a in enumerate(AMINO_ACIDS) for x in ("".join("TCAG"[(i // k) % 4] for k in (16, 4, 1)), a)])
    at = F.sequence(F.lit(0), F.floor(F.length(seq) / 3).cast("int") - 1)
    each = F.transform(at, lambda i: F.coalesce(F.try_element_at(codes, F.substr(seq, i * 3 + 1, F.lit(3))), F.lit("X")))
    return F.when(F.length(seq) >= 3, F.array_join(each, "")).otherwise(F.when(seq.isNotNull(), ""))


def to_airr(annotated: DataFrame) -> DataFrame:
    """Junction and its reading frame, bases between the segments, aligned sequences and regions.

    junction, junction_aa, junction_length, vj_in_frame, stop_codon, productive; np1 (between V and D, or V and J without
    a D) and np2 (between D and J) with their lengths; sequence_alignment and germline_alignment over V, D and J, N in the
    germline where no segment lies; fwr1 to fwr3, cdr1 and cdr2 by the columns of the numbering (null where the V row
    does not reach their end), cdr3 (the junction without its two conserved codons) and fwr4.
    """
    turned = F.when(F.col("rev_comp"), F.reverse(F.translate(F.upper("sequence"), "ACGT", "TGCA"))).otherwise(F.upper("sequence"))
    own = annotated.withColumn("_seq", turned)
    part = lambda a, b: F.when(b >= a, F.substr("_seq", a, b - a + 1)).otherwise(F.when(a.isNotNull() & b.isNotNull(), ""))
    c = F.col
    ok = (c("junction_start") >= 1) & (c("junction_end") <= F.length("_seq")) & (c("junction_end") > c("junction_start"))
    own = own.withColumn("junction", F.when(ok, part(c("junction_start"), c("junction_end"))))
    own = own.withColumn("junction_length", F.length("junction")).withColumn("junction_aa", translate(c("junction")))
    own = own.withColumn("vj_in_frame", c("junction_length") % 3 == 0).withColumn("stop_codon", c("junction_aa").contains("*"))
    own = own.withColumn("productive", F.coalesce(c("vj_in_frame") & ~c("stop_codon"), F.lit(False)))
    own = own.withColumn("np1", part(c("v_sequence_end") + 1, F.coalesce(c("d_sequence_start"), c("j_sequence_start")) - 1))
    own = own.withColumn("np2", part(c("d_sequence_end") + 1, c("j_sequence_start") - 1))
    own = own.withColumn("np1_length", F.length("np1")).withColumn("np2_length", F.length("np2"))
    some = lambda *names: F.concat(*[F.coalesce(n, F.lit("")) for n in names])
    blank = lambda n: F.repeat(F.lit("N"), F.coalesce(F.length(n), F.lit(0)))
    own = own.withColumn("sequence_alignment", F.when(c("v_row").isNotNull(), some(c("v_row"), c("np1"), c("d_row"), c("np2"), c("j_row"))))
    own = own.withColumn("germline_alignment", F.when(c("v_row").isNotNull(), some(c("v_germline"), blank("np1"), c("d_germline"), blank("np2"), c("j_germline"))))
    bases = lambda x: F.regexp_replace(x, "[.-]", "")
    for name, (a, b) in REGIONS.items():
        own = own.withColumn(name, F.when(c("v_germline").contains(".") & (F.length("v_row") >= b), bases(F.substr("v_row", F.lit(a), F.lit(b - a + 1)))))
    own = own.withColumn("cdr3", F.when(F.length("junction") >= 6, F.substr("junction", F.lit(4), F.length("junction") - 6)))
    own = own.withColumn("fwr4", F.when(c("junction").isNotNull(), part(c("junction_end") - 2, c("j_sequence_end"))))
    return own.drop("_seq", "v_row", "v_germline", "d_row", "d_germline", "j_row", "j_germline")
