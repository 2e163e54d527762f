"""Language-model scoring: a gated recurrent network over words with a class-factored softmax, in numpy.

Counts. Words and ends of all training documents are counted in one pass (partial counts in
the executors, summed by Spark); N, V and each count c give the add-one unigram base score. Of the
counts only the most frequent words, ``TOP`` at most, go to the workers; all rarer words of a document are
joined with the written count table. A second pass reads every text once more and writes its words'
symbols, which training and scoring take from there.

Model. The ``VOCAB`` most frequent words have an embedding and an output; every other word is
seen as one of ``OTHER`` classes by its last character and its first letters, within which it has
its add-one share, so the probabilities of a text's words are proper ones whatever
words it holds. The output is factored: a softmax over classes (frequency bins of the vocabulary,
the other-word classes, the end) and one over the words of the class. Its biases start at
the counts, so the untrained network is the unigram model.

Training. Truncated backpropagation over windows of ``STEPS`` words with the state carried from
window to window. A start of at most ``WARM_DOCS`` documents is trained in one task; from
there every task trains on its part of all training documents, and the tasks' weights are
averaged by their words, in a tree of sums.

Scoring. Every document runs through the network whole, many at a time: a lane that comes to
its document's end takes the next one with a fresh state, and a lane's state goes on from window
to window, so the log-likelihood is that of the complete document.

Defined cases: null text is empty and scores its end alone; a null id counts as remainder 0
(so it trains); without training documents all counts are 0 and the network stays untrained; rows that
share an id are scored each; an empty table gives an empty result; other columns are passed over.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, crc_remainder, frugal, staged

HELD_OUT = (7, 2)  # divisor and remainder
TOP = 262_144  # words that need no join; no result depends on it
VOCAB = 1024
BIN = 32  # words of a vocabulary class
OTHER = 48
HIDDEN = 24
STEPS = 32
TRAIN_LANES = 128
START_LANES = 64  # more steps from the few documents of the start
SCORE_LANES = 256
WARM_DOCS = 1500
WARM_EPOCHS = 2
RATE = 0.01
END = b"\xff"  # not UTF-8, so no word
FLUSH = 400_000
_LETTERS = frozenset(range(97, 123))


def other_class(word: bytes) -> int:
    """Class of a word outside the vocabulary: its last byte's kind and a hash of its first letters."""
    last = word[-1]
    kind = 0 if last in _LETTERS or last >= 0x80 else 1 if last in b".," else 2
    return kind * (OTHER // 3) + zlib.crc32(word[:3]) % (OTHER // 3)


def other_classes(words: pa.Array) -> np.ndarray:
    """The same of every word of a binary array, none empty, told from the few beginnings and last bytes there are."""
    def each(parts: pa.Array, tell: Callable[[bytes], int]) -> np.ndarray:
        coded = parts.dictionary_encode()
        return np.array([tell(x) for x in coded.dictionary.to_pylist()], np.int32)[coded.indices.to_numpy()]

    heads, tails = pc.binary_slice(words, 0, 3), pc.binary_slice(words, -1, None)
    return each(heads, lambda x: other_class(x) % (OTHER // 3)) + each(tails, lambda x: other_class(x) // (OTHER // 3) * (OTHER // 3)) if len(words) else np.zeros(0, np.int32)


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The lower-cased words of all texts in order, as one binary array, and the number of each text; null has none."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat = lists.flatten().cast(pa.binary())
    numbers = np.diff(lists.offsets.to_numpy())
    full = pc.binary_length(flat).to_numpy() > 0  # white space at an end of a text gives an empty piece
    if len(texts) and not full.all():
        numbers = np.add.reduceat(full, lists.offsets.to_numpy()[:-1] - lists.offsets[0].as_py(), dtype=np.int64)
        flat = flat.filter(pa.array(full))
    return flat, numbers


class Words:
    """What workers know of the counts: the top words by rank, their symbols, and the class shares."""

    def __init__(self, top: list[tuple[bytes, int]], end_count: int, other_mass: np.ndarray):
        """other_mass: sum of c + 1 over all counted words of each other-class outside the vocabulary."""
        self.top = pa.array([w for w, _ in top], pa.binary())
        counts = np.array([c for _, c in top], float)
        self.log_count = np.append(np.log10(counts + 1), 0.0)
        n_vocab = min(VOCAB, len(top))
        self.n_vocab = n_vocab
        self.end = n_vocab + OTHER
        self.symbol = np.array([i if i < n_vocab else n_vocab + other_class(w) for i, (w, _) in enumerate(top)] + [-1], np.int32)
        self.other_log = np.log10(other_mass + 1)  # one more for words never seen
        self.n_bins = -(-n_vocab // BIN)
        self.bin = np.concatenate([np.arange(n_vocab) // BIN, self.n_bins + np.arange(OTHER), [self.n_bins + OTHER]]).astype(np.int32)
        self.n_classes = self.n_bins + OTHER + 1
        mass = np.zeros(self.n_classes)
        np.add.at(mass, self.bin[:n_vocab], counts[:n_vocab] + 1)
        mass[self.n_bins : self.n_bins + OTHER] = other_mass + 1
        mass[-1] = end_count + 1
        self.class_bias = np.log(mass / mass.sum())
        self.word_bias = np.full((max(self.n_bins, 1), BIN), -1e9)
        for i in range(n_vocab):
            self.word_bias[i // BIN, i % BIN] = np.log((counts[i] + 1) / mass[i // BIN])

    def read(self, texts: pa.Array) -> list[pa.Array]:
        """Of each text the number of words and of those among the TOP; the log10 sums of c + 1 over the latter
        and of the shares of the words outside the vocabulary in their classes; the words below TOP; and the
        symbols with the end, as the bytes of 16-bit integers."""
        flat, numbers = split_words(texts)
        n, whose = len(numbers), np.repeat(np.arange(len(numbers)), numbers)
        ranks = pc.fill_null(pc.index_in(flat, self.top), -1).to_numpy()
        symbols = self.symbol[ranks]
        at = np.flatnonzero(ranks < 0)
        rare = flat.take(pa.array(at))
        symbols[at] = self.n_vocab + other_classes(rare)
        logs = self.log_count[ranks]
        outside = np.flatnonzero(symbols >= self.n_vocab)
        total = lambda which, what: np.bincount(whose[which], weights=what, minlength=n)
        n_rare = np.bincount(whose[at], minlength=n)
        every = np.full(len(symbols) + n, self.end, np.int16)
        stops = np.cumsum(numbers + 1)
        inner = np.ones(len(every), bool)
        inner[stops - 1] = False
        every[inner] = symbols
        from_zero = lambda x: pa.py_buffer(np.concatenate([[0], x]).astype(np.int32))
        return [
            pa.array(numbers, pa.int64()), pa.array(numbers - n_rare, pa.int64()), pa.array(total(slice(None), logs), pa.float64()),
            pa.array(total(outside, logs[outside] - self.other_log[symbols[outside] - self.n_vocab]), pa.float64()),
            pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n_rare)]), pa.int32()), rare),
            pa.Array.from_buffers(pa.binary(), n, [None, from_zero(stops * 2), pa.py_buffer(every)]),
        ]


# --- the network -------------------------------------------------------------------------------------

Weights = dict[str, np.ndarray]


def fresh(words: Words, seed: int = 7) -> Weights:
    rng = np.random.default_rng(seed)
    small = lambda *shape: (rng.standard_normal(shape) * 0.1).astype(np.float32)
    return {
        "in": small(words.end + 1, 3 * HIDDEN), "u": small(HIDDEN, 3 * HIDDEN) * 2, "wc": small(HIDDEN, words.n_classes) * 0.1, "bc": words.class_bias.astype(np.float32),
        "ww": small(max(words.n_bins, 1), HIDDEN, BIN) * 0.1, "bw": words.word_bias.astype(np.float32),
    }


class Lanes:
    """Documents side by side: windows of inputs, targets, start marks and document numbers, each (steps, lanes)."""

    def __init__(self, docs: Iterable[tuple[int, np.ndarray]], lanes: int, start: int):
        self.docs, self.n, self.start = iter(docs), lanes, start
        self.now: list[tuple[int, np.ndarray, int] | None] = [None] * lanes
        self.open = True
        self.last = np.full(lanes, start, np.int32)

    def _next(self) -> tuple[int, np.ndarray, int] | None:
        if self.open:
            for number, symbols in self.docs:
                return number, symbols, 0
            self.open = False
        return None

    def windows(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[int] | None]]:
        """Also yields the lanes kept when some have nothing more to do (else None)."""
        while True:
            shape = (STEPS, len(self.now))
            target = np.full(shape, -1, np.int32)
            starts, owner = np.zeros(shape, bool), np.zeros(shape, np.int64)
            busy = []
            for lane, doc in enumerate(self.now):
                t = 0
                while t < STEPS:
                    if doc is None and (doc := self._next()) is None:
                        break
                    number, symbols, at = doc
                    k = min(STEPS - t, len(symbols) - at)
                    target[t : t + k, lane] = symbols[at : at + k]
                    owner[t : t + k, lane] = number
                    if not at:
                        starts[t, lane] = True
                    t += k
                    doc = (number, symbols, at + k) if at + k < len(symbols) else None
                if t:
                    busy.append(lane)
                self.now[lane] = doc
            if not busy:
                return
            given = np.vstack([self.last, target[:-1]])  # the word before, but at starts and where nothing is left
            given[starts | (given < 0)] = self.start
            self.last, kept = target[-1], None
            if len(busy) < len(self.now):
                kept = busy
                self.now, self.last = [self.now[i] for i in busy], self.last[busy]
                given, target, starts, owner = (x[:, busy] for x in (given, target, starts, owner))
            yield given, target, starts, owner, kept


Room = dict[str, np.ndarray]  # arrays of one window that the next one writes over: fresh memory costs more than the sums in it


def _room(room: Room | None, name: str, *shape: int) -> np.ndarray:
    if room is None:
        return np.empty(shape, np.float32)
    if name not in room or room[name].shape != shape:
        room[name] = np.empty(shape, np.float32)
    return room[name]


def _by_gate(x: np.ndarray) -> np.ndarray:
    """(rows, 3 * HIDDEN) as (3, rows, HIDDEN), so that the work on a gate runs over one stretch of memory."""
    return np.ascontiguousarray(x.reshape(len(x), 3, HIDDEN).swapaxes(0, 1))


def _forward(w: Weights, given: np.ndarray, starts: np.ndarray, h: np.ndarray, keep: bool, room: Room | None = None):
    """Hidden states (steps, lanes, HIDDEN) after each input, and what backpropagation needs."""
    steps, lanes = given.shape
    table, u = _by_gate(w["in"]), _by_gate(w["u"])
    for x in (table, u):  # a sigmoid is 1 / (1 + exp(-x)), a tanh 2 / (1 + exp(-2x)) - 1
        x[:2] *= -1
        x[2] *= -2
    g = table.take(given, axis=1, out=_room(room, "g", 3, steps, lanes, HIDDEN), mode="clip") if room is not None else table.take(given, axis=1)
    states = _room(room, "states", steps, lanes, HIDDEN)
    kept = steps if keep else 1
    before, news = (_room(room, name, kept, lanes, HIDDEN) for name in ("before", "news"))
    parts = _room(room, "parts", 3, kept, lanes, HIDDEN)  # both gates and -2 times the inner product of the new state
    alive = (~starts).astype(np.float32)[:, :, None]
    any_start = starts.any(axis=1)
    before[0] = h
    with np.errstate(over="ignore"):  # of exp, whose inverse is then 0
        for t in range(steps):
            k = t if keep else 0
            if any_start[t]:
                h = h * alive[t]
            a, n = np.matmul(h, u, out=parts[:, k]), news[k]
            zr = a[:2]
            zr += g[:2, t]
            np.exp(zr, out=zr)
            zr += 1
            np.reciprocal(zr, out=zr)
            np.multiply(zr[1], a[2], out=n)
            n += g[2, t]
            np.exp(n, out=n)
            n += 1
            np.divide(2, n, out=n)
            n -= 1
            h = np.subtract(h, n, out=states[t])
            h *= zr[0]
            h += n
    if keep:
        before[1:] = states[:-1]
        before *= alive
    return states, h.copy(), (before, parts, news) if keep else None


def _shift(x: np.ndarray, weights: np.ndarray, bias: np.ndarray) -> None:
    """Lowers each row by its largest value, in place, unless no state (all within -1 and 1) can bring its exponentials out of range."""
    reach = np.abs(weights).sum(axis=-2)
    if np.max(bias + reach) > 60 or np.min(np.max(bias - reach, axis=-1)) < -60:
        x -= x.max(axis=1, keepdims=True)


def _class_odds(w: Weights, flat: np.ndarray, room: Room | None = None) -> np.ndarray:
    """Of each row the classes' logits, made fit for exponentials."""
    x = np.matmul(flat, w["wc"], out=_room(room, "odds", len(flat), w["wc"].shape[1]) if room is not None else None)
    x += w["bc"]
    _shift(x, w["wc"], w["bc"])
    return x


def _class_logs(w: Weights, flat: np.ndarray, chosen: np.ndarray, room: Room | None) -> np.ndarray:
    """The log-softmax of one class of each row. Where all is well in range, biases are weights of the sum, not a pass over all logits."""
    bias = w["bc"]
    if max(np.abs(w["wc"]).sum(axis=0).max(), np.abs(bias).max()) > 40:
        return _log_chosen(_class_odds(w, flat, room), chosen)
    x = np.matmul(flat, w["wc"], out=_room(room, "odds", len(flat), len(bias)) if room is not None else None)
    own = x[np.arange(len(x)), chosen] + bias[chosen]
    np.exp(x, out=x)
    return own - np.log(x @ np.exp(bias))


def _word_odds(w: Weights, here: np.ndarray, parts: list[tuple[int, slice]]) -> np.ndarray:
    """The same for the words of each row's class; rows are in order of class and end with a 1, for the bias."""
    x = np.empty((len(here), BIN), here.dtype)
    both = np.concatenate([w["ww"], w["bw"][:, None]], axis=1)
    for k, part in parts:
        np.matmul(here[part], both[k], out=x[part])
    _shift(x, w["ww"], w["bw"])
    return x


def _with_one(flat: np.ndarray, rows: np.ndarray) -> np.ndarray:
    out = np.ones((len(rows), HIDDEN + 1), flat.dtype)
    out[:, :HIDDEN] = flat[rows]
    return out


def _row_sums(x: np.ndarray) -> np.ndarray:
    return x @ np.ones(x.shape[1], x.dtype)


def _log_chosen(x: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The log-softmax of one column of each row; x is used up."""
    own = x[np.arange(len(x)), chosen]
    np.exp(x, out=x)
    return own - np.log(_row_sums(x))


def _excess(x: np.ndarray, chosen: np.ndarray, share: np.float32) -> np.ndarray:
    """share times the softmax less one at the chosen column, in place: the gradient of minus the log-likelihood."""
    np.exp(x, out=x)
    x *= (share / _row_sums(x))[:, None]
    x[np.arange(len(x)), chosen] -= share
    return x


def _by_bin(words: Words, goal: np.ndarray, cls: np.ndarray) -> tuple[np.ndarray, list[tuple[int, slice]]]:
    """The rows with a word of the vocabulary in order of its class, and the span of each class."""
    rows = np.flatnonzero(goal < words.n_vocab)
    rows = rows[np.argsort(cls[rows].astype(np.int16), kind="stable")]
    own = cls[rows]
    edges = [0, *(np.flatnonzero(np.diff(own)) + 1).tolist(), len(own)]
    return rows, [(int(own[a]), slice(a, b)) for a, b in zip(edges, edges[1:]) if b > a]


def log_likelihood(w: Weights, words: Words, states: np.ndarray, target: np.ndarray, room: Room | None = None) -> np.ndarray:
    """Natural log of each target's class and, in the vocabulary, of the word in it; 0 where there is no target."""
    flat, goal = states.reshape(-1, HIDDEN), target.ravel()
    out = np.zeros(len(goal), np.float64)
    at = np.flatnonzero(goal >= 0)
    if len(at) < len(goal):
        flat = flat[at]
    goal = goal[at]
    cls = words.bin[goal]
    out[at] = _class_logs(w, flat, cls, room)
    rows, parts = _by_bin(words, goal, cls)
    out[at[rows]] += _log_chosen(_word_odds(w, _with_one(flat, rows), parts), goal[rows] % BIN)
    return out.reshape(target.shape)


def _gradients(w: Weights, words: Words, given, target, starts, states, store, room: Room | None = None) -> tuple[Weights, int]:
    steps, lanes = given.shape
    flat, goal = states.reshape(-1, HIDDEN), target.ravel()
    at = np.flatnonzero(goal >= 0)
    share = np.float32(1 / max(len(at), 1))
    grads: Weights = {k: np.zeros_like(v) for k, v in w.items() if k in ("ww", "bw")}
    seen, goal = flat[at] if len(at) < len(goal) else flat, goal[at]
    cls = words.bin[goal]
    p = _excess(_class_odds(w, seen, room), cls, share)
    grads["wc"], grads["bc"] = (p.T @ seen).T, np.ones(len(p), p.dtype) @ p
    back = p @ w["wc"].T
    rows, parts = _by_bin(words, goal, cls)
    here = _with_one(seen, rows)
    q = _excess(_word_odds(w, here, parts), goal[rows] % BIN, share)
    inner_back = np.empty((len(rows), HIDDEN), here.dtype)
    for k, part in parts:
        both = here[part].T @ q[part]
        grads["ww"][k], grads["bw"][k] = both[:-1], both[-1]
        np.matmul(q[part], w["ww"][k].T, out=inner_back[part])
    back[rows] += inner_back
    if len(at) < steps * lanes:
        full = np.zeros((steps * lanes, HIDDEN), np.float32)
        full[at] = back
    else:
        full = back
    full = full.reshape(steps, lanes, HIDDEN)
    before, (z, r, inner), news = store
    # factors of a state's gradient: new state, both gates, and the new state's inner product; the first
    # three lead to the inputs, the last three to the recurrent weights
    d = _room(room, "d", 4, steps, lanes, HIDDEN)
    left, new, zs, rs = d[3], d[0], d[1], d[2]
    np.subtract(1, z, out=left)
    np.multiply(news, news, out=new)
    np.subtract(1, new, out=new)
    new *= left
    np.subtract(before, news, out=zs)
    zs *= z
    zs *= left
    np.multiply(new, r, out=left)
    np.subtract(r, 1, out=rs)
    rs *= inner
    rs *= np.float32(0.5)
    rs *= left
    alive = (~starts).astype(np.float32)[:, :, None]
    any_start = starts.any(axis=1)
    turned = np.ascontiguousarray(_by_gate(w["u"]).swapaxes(1, 2))
    carried, each = np.zeros((lanes, HIDDEN), np.float32), np.empty((3, lanes, HIDDEN), np.float32)
    for t in range(steps - 1, -1, -1):
        dh, now = full[t], d[:, t]
        dh += carried
        now *= dh
        np.matmul(now[1:], turned, out=each)
        np.multiply(dh, z[t], out=carried)
        carried += each[0]
        carried += each[1]
        carried += each[2]
        if any_start[t]:
            carried *= alive[t]
    d = d.reshape(4, -1, HIDDEN)
    grads["u"] = (d[1:].swapaxes(1, 2) @ before.reshape(-1, HIDDEN)).reshape(-1, HIDDEN).T
    grads["in"] = _sums_by_id(given.ravel(), d, len(w["in"]))
    return grads, len(at)


def _sums_by_id(ids: np.ndarray, d: np.ndarray, n: int) -> np.ndarray:
    """Of each id the summed rows of both gates and of the new state; two columns are added at once, as a complex number."""
    order = np.argsort(ids.astype(np.int16), kind="stable")
    firsts = np.flatnonzero(np.diff(ids[order], prepend=-1))
    rows = np.hstack([d[i].take(order, axis=0) for i in (1, 2, 0)])
    out = np.zeros((n, 3 * HIDDEN), np.float32)
    out[ids[order[firsts]]] = np.add.reduceat(rows.view(np.complex64), firsts, axis=0).view(np.float32)
    return out


def train(w: Weights, words: Words, docs: Iterable[tuple[int, np.ndarray]], rate: float = RATE, lanes: int = TRAIN_LANES) -> int:
    """Adam steps in place, one for each window; returns the number of words."""
    flat = np.concatenate([v.ravel() for v in w.values()])
    ends = np.cumsum([v.size for v in w.values()])
    own = {k: flat[end - v.size : end].reshape(v.shape) for (k, v), end in zip(w.items(), ends)}
    m, v, g, x = (np.zeros_like(flat) for _ in range(4))
    total = step = 0
    h, room = np.zeros((lanes, HIDDEN), np.float32), {}
    for given, target, starts, _, kept in Lanes(docs, lanes, words.end).windows():
        if kept is not None:
            h = h[kept]
        states, h, store = _forward(own, given, starts, h, True, room)
        grads, n = _gradients(own, words, given, target, starts, states, store, room)
        np.concatenate([grads[k].ravel() for k in own], out=g)
        g *= min(1.0, 1.0 / (float(np.sqrt(g @ g)) + 1e-12))
        total, step = total + n, step + 1
        now = rate / (1 + step / 400) * min(1.0, n / (STEPS * lanes / 4))
        first, second = 1 / (1 - 0.9**step), (1 - 0.999**step) ** -0.5
        for at in range(0, len(flat), 1 << 14):  # pieces that stay in the cache
            g_, m_, v_, x_ = (a[at : at + (1 << 14)] for a in (g, m, v, x))
            np.subtract(g_, m_, out=x_)
            x_ *= 0.1
            m_ += x_
            g_ *= g_
            g_ -= v_
            g_ *= 0.001
            v_ += g_
            np.sqrt(v_, out=x_)
            x_ *= second
            x_ += 1e-8
            np.divide(m_, x_, out=x_)
            x_ *= now * first
            flat[at : at + (1 << 14)] -= x_
    for k in w:
        w[k][...] = own[k]
    return total


# --- distributed ----------------------------------------------------------------------------------------

def count_words(docs: DataFrame) -> DataFrame:
    """word (binary; END for ends) and c over the column ``_t`` of the training rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, ends = [], 0, 0
        for b in batches:
            found = split_words(b.column(0))[0].value_counts()
            held.append(pa.table([found.field(0), found.field(1)], names=["word", "c"]))
            size, ends = size + len(found), ends + b.num_rows
            if size > 2 * FLUSH:
                held = [_summed(held)]
                size = len(held[0])
                if size > FLUSH:
                    yield from held.pop().to_batches(max_chunksize=20_000)
                    size = 0
        held.append(pa.table([pa.array([END], pa.binary()), pa.array([ends], pa.int64())], names=["word", "c"]))
        yield from _summed(held).to_batches(max_chunksize=20_000)

    return docs.select("_t").mapInArrow(frugal(run), "word binary, c long").where("c > 0").groupBy("word").agg(F.sum("c").alias("c"))


def _summed(tables: list[pa.Table]) -> pa.Table:
    out = pa.concat_tables(tables).group_by("word", use_threads=False).aggregate([("c", "sum")])
    return pa.table([out.column("word"), out.column("c_sum")], names=["word", "c"])


def _other_mass(counts: DataFrame) -> np.ndarray:
    """Sum of c + 1 over the counted words of each other-class."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mass = np.zeros(OTHER)
        for b in batches:
            mass += np.bincount(other_classes(b.column(0)), weights=b.column(1).to_numpy() + 1.0, minlength=OTHER)
        yield pa.RecordBatch.from_arrays([pa.array(range(OTHER), pa.int32()), pa.array(mass)], names=["k", "m"])

    out = np.zeros(OTHER)
    for r in counts.mapInArrow(frugal(run), "k int, m double").groupBy("k").agg(F.sum("m").alias("m")).collect():
        out[r["k"]] = r["m"]
    return out


def top_words(counts: DataFrame) -> list[tuple[bytes, int]]:
    """The vocabulary by count, then word; after it, in the same order, the words of the least count that TOP has room for and more."""
    of = lambda rows: [(bytes(r["word"]), r["c"]) for r in rows]
    first = of(counts.orderBy(F.desc("c"), "word").limit(min(VOCAB, TOP)).collect())
    seen, least = 0, None
    for r in counts.groupBy("c").agg(F.count("*").alias("n")).orderBy(F.desc("c")).toLocalIterator():
        seen += r["n"]
        if seen > TOP:
            break
        least = r["c"]
    if least is None:
        return first
    known = {w for w, _ in first}
    more = (x for x in of(counts.where(F.col("c") >= least).toLocalIterator()) if x[0] not in known)
    return first + sorted(more, key=lambda x: (-x[1], x[0]))


_READ = "n_words long, n_known long, log_all double, log_other double, rare array<binary>, symbols binary"


def read_texts(docs: DataFrame, words: Words) -> DataFrame:
    """What ``Words.read`` says of the column ``_t``, in its place; other columns stay."""
    known = docs.sparkSession.sparkContext.broadcast(words)  # TOP words at most
    others = [c for c in docs.columns if c != "_t"]
    names = [*others, *(x.split()[0] for x in _READ.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns[1:], *known.value.read(b.column(0))], names=names)

    kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in others)
    return docs.select("_t", *others).mapInArrow(frugal(run), f"{kinds}, {_READ}")


def _symbols(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
    for b in batches:
        for x in b.column(0).to_pylist():
            yield 0, np.frombuffer(x, np.int16)


_MODEL = "k int, words double, model binary"


def _pack(w: Weights, total: float) -> pd.DataFrame:
    return pd.DataFrame({"k": [0], "words": [float(total)], "model": [pickle.dumps(w)]})


def _average(rows: pd.DataFrame) -> pd.DataFrame:
    total = max(rows["words"].sum(), 1.0)
    mean: Weights = {}
    for n, m in zip(rows["words"], rows["model"], strict=True):
        for k, v in pickle.loads(m).items():
            mean[k] = mean.get(k, 0) + v.astype(np.float64) * (n / total)
    return _pack({k: v.astype(np.float32) for k, v in mean.items()}, rows["words"].sum())


def fit_network(trainable: DataFrame, words: Words, n_docs: int) -> Weights:
    """Weights from the column ``_t`` of the training rows (with ``_key``, a hash)."""
    return train_network(read_texts(trainable, words), words, n_docs)


def train_network(trainable: DataFrame, words: Words, n_docs: int) -> Weights:
    """Weights from the column ``symbols`` of the training rows (with ``_key``, a hash)."""
    spark = trainable.sparkSession
    known = spark.sparkContext.broadcast(words)  # TOP words at most
    w = fresh(words)
    if not n_docs:
        return w
    unit = (F.col("_key") % (1 << 20) + (1 << 20)) % (1 << 20)
    warm = staged(trainable.where(unit < int((1 << 20) * min(1.0, WARM_DOCS / n_docs) + 1)).limit(WARM_DOCS).select("symbols"), "lm-start")

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, held = fresh(known.value), [s for _, s in _symbols(batches)]
        for _ in range(WARM_EPOCHS):
            train(own, known.value, ((0, s) for s in held), lanes=START_LANES)
        yield pa.RecordBatch.from_pandas(_pack(own, 1), preserve_index=False).cast(_ARROW)

    first = warm.coalesce(1).mapInArrow(frugal(start), _MODEL).first()
    if first is not None:
        w = pickle.loads(first["model"])
    begin = spark.sparkContext.broadcast(w)

    def go_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = {k: v.copy() for k, v in begin.value.items()}
        total = train(own, known.value, _symbols(batches), RATE / 3)
        if total:
            yield pa.RecordBatch.from_pandas(_pack(own, total), preserve_index=False).cast(_ARROW)

    parts = trainable.select("symbols").mapInArrow(frugal(go_on), _MODEL)
    some = parts.groupBy((F.xxhash64("model") % 64).alias("_part")).applyInPandas(_average, _MODEL)
    mean = some.groupBy("k").applyInPandas(_average, _MODEL).first()
    return w if mean is None else pickle.loads(mean["model"])


_ARROW = pa.schema([("k", pa.int32()), ("words", pa.float64()), ("model", pa.binary())])


def _score(read: DataFrame, words: Words, w: Weights) -> DataFrame:
    """Of each row of ``read_texts``: rid, doc, held_out, n_words, n_known, log_all and score, the network's log10."""
    known, network = (read.sparkSession.sparkContext.broadcast(x) for x in (words, w))
    names = ["rid", "doc", "held_out", "n_words", "n_known", "log_all"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, w = known.value, network.value
        waiting: dict[int, list] = {}
        types: list[pa.DataType] = []

        def docs() -> Iterator[tuple[int, np.ndarray]]:
            number = 0
            for b in batches:
                types[:] = [*b.schema.types[:6], pa.float64()]
                for *row, log_other, symbols in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    waiting[number] = [*row, log_other]
                    yield number, np.frombuffer(symbols, np.int16)
                    number += 1

        h, room = np.zeros((SCORE_LANES, HIDDEN), np.float32), {}
        done: list[list] = []
        for given, target, starts, owner, kept in Lanes(docs(), SCORE_LANES, words.end).windows():
            if kept is not None:
                h = h[kept]
            states, h, _ = _forward(w, given, starts, h, False, room)
            logs = log_likelihood(w, words, states, target, room) / np.log(10)
            real = target >= 0
            whose, logs = owner[real], logs[real]
            least = int(whose.min())
            if int(whose.max()) - least < 1 << 16:
                numbers, at = np.flatnonzero(np.bincount(whose - least)) + least, whose - least
                sums = np.bincount(at, weights=logs)[numbers - least]
            else:
                numbers, at = np.unique(whose, return_inverse=True)
                sums = np.bincount(at, weights=logs)
            for number, own in zip(numbers.tolist(), sums.tolist()):
                waiting[number][6] += own
            for number in owner[target == words.end].tolist():
                done.append(waiting.pop(number))
            if len(done) >= 1000:
                yield _scored(done, types)
                done = []
        if done:
            yield _scored(done, types)

    def _scored(rows: list[list], types: list[pa.DataType]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=[*names, "score"])

    kinds = ", ".join(f"{c} {read.schema[c].dataType.simpleString()}" for c in names)
    return read.select(*names, "log_other", "symbols").mapInArrow(frugal(run), f"{kinds}, score double")


def score_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    spark = docs.sparkSession
    bounded_batches(spark)
    divisor, remainder = HELD_OUT
    held = crc_remainder(F.col(key), divisor) == remainder
    own = docs.select(
        F.monotonically_increasing_id().alias("rid"), F.col(key).alias("doc"), held.alias("held_out"),
        F.xxhash64(F.col(key).cast("string"), F.lit("train")).alias("_key"), F.col(text).alias("_t"))
    counts = staged(count_words(own.where(~F.col("held_out"))), "lm-counts")
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    ends = counts.where(F.col("word") == F.lit(END)).first()
    ends = ends["c"] if ends else 0
    plain = counts.where(F.col("word") != F.lit(END))
    top = top_words(plain)
    mass = _other_mass(plain)
    for w, c in top[:VOCAB]:
        mass[other_class(w)] -= c + 1
    words = Words(top, ends, np.maximum(mass, 0))
    read = staged(read_texts(own, words), "lm-read")
    network = train_network(read.where(~F.col("held_out")), words, ends)
    scored = staged(_score(read, words, network), "lm-scored")
    rare = read.select("rid", F.explode("rare").alias("word")).join(plain, "word")
    rare = rare.groupBy("rid").agg(F.count("*").alias("k"), F.sum(F.log10(F.col("c") + 1)).alias("log_rare"))
    each = F.lit(float(np.log10(total["n"] + total["v"] + 1)))
    none = lambda c: F.coalesce(F.col(c), F.lit(0))
    return scored.join(rare, "rid", "left").select(
        F.col("doc").alias(key), "held_out", (F.col("n_words") + 1).alias("n_tokens"),
        (F.col("n_known") + none("k") + (1 if ends else 0)).cast("long").alias("n_known"), F.lit(int(total["n"])).cast("long").alias("train_tokens"),
        (F.col("log_all") + none("log_rare") + float(np.log10(ends + 1)) - (F.col("n_words") + 1) * each).alias("base_score"),
        (F.col("score") + none("log_rare")).alias("score"))
