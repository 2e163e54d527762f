"""Pairwise alignment of many pairs at once: local, affine gaps, within a band of diagonals.

All pairs of a batch advance together, one reference base at a time, as rows of one numpy table; the ways back are followed
together as well. A gap of n bases costs OPEN + n * EXTEND. Of equal ends the one first in the reference, then in the query, counts;
on the way back a match comes before a reference base without partner and that before a query base without one.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

MATCH, MISMATCH, OPEN, EXTEND = 1, -2, -3, -1
#: Net bases that a path may move away from its main diagonal.
BAND = 32
#: Cells (reference bases x pairs x band) of one table.
CELLS = 1 << 25
#: Pairs that are scored together, without ways back: a table of them stays in the processor's cache.
PAIRS = 1024
#: What ``partners`` says of a reference base that the path passes without a query base, or does not reach.
DELETED, UNREACHED = -1, -2


class Alignments(NamedTuple):
    """One entry for each pair; ends are exclusive. ``partners`` has the query position of each reference base."""

    score: np.ndarray
    ref_start: np.ndarray
    ref_end: np.ndarray
    query_start: np.ndarray
    query_end: np.ndarray
    matches: np.ndarray
    columns: np.ndarray
    partners: list[np.ndarray]


def codes(seq: str) -> np.ndarray:
    """A byte for each letter; letters beyond ASCII count as '?'."""
    return np.frombuffer(seq.encode("ascii", "replace"), np.uint8)


def local(queries: list[np.ndarray], refs: list[np.ndarray], diagonals: np.ndarray, band: int = BAND, paths: bool = True) -> Alignments:
    """The best local alignment of each query with its reference around a diagonal (query minus reference position)."""
    n = len(queries)
    made = Alignments(*(np.zeros(n, np.int64) for _ in range(7)), [np.empty(0, np.int32)] * n)
    order = sorted(range(n), key=lambda p: len(refs[p]))
    at = 0
    while at < n:  # pairs of like length share a table
        longest, end = len(refs[order[at]]), at
        most = max(1, CELLS // (2 * band + 1) // (2 * longest + 64)) if paths else PAIRS
        while end < n and end - at < most and len(refs[order[end]]) <= 1.25 * longest + 32:
            end += 1
        own = order[at:end]
        part = _table([queries[p] for p in own], [refs[p] for p in own], diagonals[own], band, paths)
        for whole, some in zip(made[:7], part[:7], strict=True):
            whole[own] = some
        for p, x in zip(own, part.partners, strict=True):
            made.partners[p] = x
        at = end
    return made


def _table(queries: list[np.ndarray], refs: list[np.ndarray], diagonals: np.ndarray, band: int, paths: bool) -> Alignments:
    n, width = len(queries), 2 * band + 1
    length = max(map(len, refs))
    ref = np.zeros((n, length), np.uint8)
    for p, r in enumerate(refs):
        ref[p, : len(r)] = r
    sizes = np.array([len(q) for q in queries])
    flat, offsets = np.concatenate([*queries, np.zeros(1, np.uint8)]), np.cumsum([0, *sizes[:-1]])
    place = np.arange(length + width)[None, :] + (diagonals - band)[:, None]
    inside = (place >= 0) & (place < sizes[:, None])
    query = np.where(inside, flat[np.where(inside, place + offsets[:, None], 0)], 0)

    # tables lie band by pair, so that every step is one operation over all pairs
    kind = np.int16 if MATCH * length < 1 << 13 else np.int32
    out_of = kind(-(1 << 14))
    steps = (EXTEND * np.arange(width)).astype(kind)[:, None]
    cost, extend = kind(OPEN + EXTEND), kind(EXTEND)
    query_t, ref_t = np.ascontiguousarray(query.T), np.ascontiguousarray(ref.T)
    h, down = np.zeros((width, n), kind), np.full((width, n), out_of, kind)
    new, plain, diagonal, e, opened, spare = (np.full((width, n), out_of, kind) for _ in range(6))
    best, best_row, best_at = np.zeros(n, kind), np.zeros(n, np.int64), np.zeros(n, np.int64)
    came = np.empty((length, width, n), np.uint8) if paths else None
    padded = (ref_t == 0).any(axis=1)
    unpaired = (query_t == 0).any(axis=1)
    for i in range(length):
        q, r = query_t[i : i + width], ref_t[i]
        np.multiply(q == r, kind(MATCH - MISMATCH), out=diagonal, casting="unsafe")
        diagonal += h
        diagonal += kind(MISMATCH)
        if unpaired[i : i + width].any():
            diagonal[q == 0] = out_of
        if padded[i]:
            diagonal[:, r == 0] = out_of
        np.add(h[1:], cost, out=opened[:-1])
        np.add(down[1:], extend, out=down[:-1])
        np.maximum(opened[:-1], down[:-1], out=down[:-1])
        down[-1] = out_of
        np.maximum(diagonal, down, out=plain)
        np.maximum(plain, 0, out=plain)
        np.subtract(plain, steps, out=spare)
        for k in range(1, width - 1):
            np.maximum(spare[k], spare[k - 1], out=spare[k])
        np.add(spare[:-1], steps[1:] + kind(OPEN), out=e[1:])
        np.maximum(plain, e, out=new)
        if paths:
            source = np.where(new == diagonal, 1, np.where(new == down, 2, 3)).astype(np.uint8)
            source[new == 0] = 0
            source[:-1] |= (down[:-1] == opened[:-1]).astype(np.uint8) << 2
            source[1:] |= (e[1:] == plain[:-1] + cost).astype(np.uint8) << 3
            came[i] = source
        top = new.max(axis=0)
        better = np.flatnonzero(top > best)
        if len(better):
            best[better], best_row[better] = top[better], i
            if paths:
                best_at[better] = new[:, better].argmax(axis=0)
        h, new = new, h
    ends = best_row + 1
    query_end = best_row + diagonals - band + best_at + 1
    zero = np.zeros(n, np.int64)
    if not paths:
        return Alignments(best.astype(np.int64), zero, ends, zero, query_end, zero, zero, [np.empty(0, np.int32)] * n)

    partners = np.full((n, length), UNREACHED, np.int32)
    row, at, mode = best_row.copy(), best_at.copy(), np.zeros(n, np.int64)
    matches, columns, ref_start, query_start = (np.zeros(n, np.int64) for _ in range(4))
    live = np.flatnonzero(best > 0)
    while len(live):
        i, b = row[live], at[live]
        told = came[i, b, live]
        now = np.where(mode[live] > 0, mode[live], told & 3)
        stop = now == 0
        if stop.any():
            live, i, b, told, now = live[~stop], i[~stop], b[~stop], told[~stop], now[~stop]
        columns[live] += 1
        d = now == 1
        pairs = live[d]
        j = i[d] + diagonals[pairs] - band + b[d]
        partners[pairs, i[d]] = j
        matches[pairs] += query[pairs, i[d] + b[d]] == ref[pairs, i[d]]
        ref_start[pairs], query_start[pairs] = i[d], j
        row[pairs] -= 1
        mode[pairs] = 0
        g = now == 2
        gone = live[g]
        partners[gone, i[g]] = DELETED
        row[gone] -= 1
        at[gone] += 1
        mode[gone] = np.where(told[g] & 4, 0, 2)
        x = now == 3
        more = live[x]
        at[more] -= 1
        mode[more] = np.where(told[x] & 8, 0, 3)
        live = live[(row[live] >= 0) & (at[live] >= 0) & (at[live] < width)]
    return Alignments(best.astype(np.int64), ref_start, ends, query_start, query_end, matches, columns, [partners[p, : len(r)] for p, r in enumerate(refs)])


def runs(a: Alignments, p: int) -> list[tuple[int, str]]:
    """M, D and I runs of a pair's path."""
    first, last = int(a.ref_start[p]), int(a.ref_end[p])
    if a.columns[p] == last - first == a.query_end[p] - a.query_start[p]:
        return [(last - first, "M")] if last > first else []
    to = a.partners[p][first:last]
    there = np.flatnonzero(to >= 0)
    inserted = np.zeros(len(to), np.int64)
    inserted[there[1:]] = np.diff(to[there]) - 1  # query bases between neighbours
    kept = to >= 0
    begin = inserted > 0
    begin[1:] |= kept[1:] != kept[:-1]
    begin[0] = True
    cuts = np.flatnonzero(begin)
    out: list[tuple[int, str]] = []
    for n, own, more in zip(np.diff(np.append(cuts, len(to))).tolist(), kept[cuts].tolist(), inserted[cuts].tolist(), strict=True):
        out += [(more, "I"), (n, "M" if own else "D")] if more else [(n, "M" if own else "D")]
    return out


def joined(runs: list[tuple[int, str]], before: int, first: int, behind: int) -> str:
    """S (query bases outside), N (reference bases before), then the runs of the path."""
    return "".join([f"{n}{k}" for n, k in [(before, "S"), (first, "N"), *runs, (behind, "S")] if n])


def cigar(a: Alignments, p: int, query_length: int) -> str:
    return joined(runs(a, p), int(a.query_start[p]), int(a.ref_start[p]), query_length - int(a.query_end[p]))
