"""Toxicity: a weighted lexicon, matched by Aho-Corasick on folded text.

Folding lower-cases, maps homoglyphs (Cyrillic, Greek, full-width and accented letters),
digits and ``@ $`` that stand for letters, and makes all other marks blanks, so that every
entry is a blank and a stem and matches at word starts only. One pass of the automaton
finds all stems and all exception phrases; a stem inside an exception phrase does not
count. The sum of the weights, as it is and per word of the text, and the
heaviest entry give the score through a logistic function.

The lexicon is a short fixed list and the stems learned from labelled texts: the stems of
``STEM`` letters which toxic texts hold significantly more often (G-test), each with its log
odds as weight. Learning reads at most ``TRAIN_ROWS`` labelled rows (those with the smallest
hashes), counts in the executors, and brings at most ``LEARNED`` stems to the driver.

Defined cases: null text counts as empty; an empty text scores as a text without a hit;
labels without a toxic (or clean) row leave the fixed lexicon with fixed coefficients;
several labels of one id count as toxic if one is; an empty table gives an empty result;
other columns are passed over.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, crc_remainder, frugal, staged

#: Bounds of the training: labelled rows read, stems kept, letters of a stem.
TRAIN_ROWS = 20_000
LEARNED = 2_000
STEM = range(4, 10)
LEAST_TOXIC = 4
LEAST_G = 24.0
LEAST_WEIGHT = 1.5
HELD_OUT = 5

#: Stems with their weights before any label is seen, and phrases in which they mean no harm.
SEED_LEXICON = {
    "idiot": 3.0, "moron": 3.0, "stupid": 2.5, "scum": 3.0, "worthless": 2.5, "pathetic": 2.5,
    "disgusting": 2.5, "loser": 2.5, "trash": 2.0, "clown": 2.0, "imbecil": 3.0, "dumbass": 3.5, "retard": 3.0,
}
EXCEPTIONS = (
    "trash can", "trash bin", "trash bag", "trash collection", "clown fish", "clownfish", "circus clown",
    "idiot proof", "moronic acid", "losers bracket", "pathetic fallacy", "flame retard",
)
#: Letters of other scripts, digits and signs read as Latin letters.
LOOK_ALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "һ": "h", "ԁ": "d",
    "к": "k", "м": "m", "т": "t", "в": "b", "н": "h", "г": "r", "п": "n", "и": "u", "ь": "b", "л": "n", "ӏ": "l",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "ı": "i", "ø": "o", "ł": "l", "đ": "d", "ß": "ss", "æ": "ae", "œ": "oe",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s",
}


class _Folding(dict):
    """Code point to folded text, worked out when first met."""

    def __missing__(self, point: int) -> str:
        c = chr(point)
        if c in LOOK_ALIKES:
            out = LOOK_ALIKES[c]
        else:
            plain = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x)).lower()
            out = "".join(LOOK_ALIKES.get(x, x) for x in plain if x.isalnum() or x in LOOK_ALIKES)
            if not out and not unicodedata.combining(c) and point not in (0xAD, 0x200B, 0x200C, 0x200D, 0xFEFF):
                out = " "
        self[point] = out
        return out


_folding = _Folding()


def fold(text: str) -> str:
    """Folded text between two blanks, its words one blank apart."""
    return f" {' '.join(text.lower().translate(_folding).split())} "


@dataclass(frozen=True)
class Model:
    """Stems with weights, exception phrases, and intercept and slopes of the logistic function."""

    lexicon: dict[str, float]
    exceptions: tuple[str, ...]
    slopes: tuple[float, ...]

    def automaton(self) -> ahocorasick.Automaton:
        a = ahocorasick.Automaton()
        for stem, weight in self.lexicon.items():
            a.add_word(f" {stem}", (len(stem) + 1, weight))
        for phrase in self.exceptions:
            folded = fold(phrase).rstrip()
            a.add_word(folded, (len(folded), None))
        a.make_automaton()
        return a


def evidence(text: str, automaton: ahocorasick.Automaton) -> tuple[float, float, float, int]:
    """Features of one text: log of the summed weights, log of that per 100 words, the heaviest entry; and the hits."""
    if not len(automaton):
        return 0.0, 0.0, 0.0, 0
    folded = fold(text)
    hits: dict[int, float] = {}  # by start: of the stems that begin at a word the heaviest counts
    spans: list[tuple[int, int]] = []
    for end, (length, weight) in automaton.iter(folded):
        start = end - length + 1
        if weight is None:
            spans.append((start, end))
        elif weight > hits.get(start, 0.0):
            hits[start] = weight
    if spans and hits:  # one sweep: what starts within a phrase is excused
        spans.sort()
        at, reach = 0, -1
        for start in sorted(hits):
            while at < len(spans) and spans[at][0] <= start:
                reach = max(reach, spans[at][1])
                at += 1
            if start <= reach:
                del hits[start]
    if not hits:
        return 0.0, 0.0, 0.0, 0
    total = sum(hits.values())
    words = max(len(folded.split()), 1)
    return float(np.log1p(total)), float(np.log1p(100 * total / words)), max(hits.values()), len(hits)


FIXED_SLOPES = (-3.0, 1.0, 0.5, 0.8)


def logistic(rows: np.ndarray, toxic: np.ndarray, ridge: float = 1e-2) -> tuple[float, ...]:
    """Intercept and slopes by Newton's method."""
    x = np.hstack([np.ones((len(rows), 1)), rows])
    w = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (toxic - p) - ridge * w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(map(float, w))


def _stems(text: str) -> set[str]:
    words = {w for w in fold(text).split() if len(w) >= STEM.start}
    return {w[:k] for w in words for k in STEM if k <= len(w)}


def training_rows(docs: DataFrame, labels: DataFrame, key: str, text: str) -> DataFrame:
    """text and toxic of at most TRAIN_ROWS labelled rows outside the held-out fold."""
    own = labels.where((crc_remainder(F.col(key), HELD_OUT) != 0) & F.col("toxic").isNotNull() & F.col(key).isNotNull())
    own = own.groupBy(key).agg(F.max("toxic").alias("toxic"))
    picked = staged(own.orderBy(F.xxhash64(F.col(key)), F.col(key)).limit(TRAIN_ROWS), "toxic-ids")
    return docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("text")).join(F.broadcast(picked), key).select("text", "toxic")


def learn_stems(train: DataFrame, n_toxic: int, n_clean: int) -> dict[str, float]:
    """Stems that toxic texts hold significantly more often, and their log odds."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both: tuple[Counter, Counter] = (Counter(), Counter())
        for b in batches:
            for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                both[toxic == 1].update(_stems(text))
            if len(both[0]) > 300_000 or len(both[1]) > 100_000:
                yield from _counted(both)
                both = (Counter(), Counter())
        yield from _counted(both)

    counts = train.mapInArrow(frugal(count, _folding.clear), "stem string, toxic long, clean long").groupBy("stem").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("c"))
    a, c = F.col("a").cast("double"), F.col("c").cast("double")
    n, share = float(n_toxic + n_clean), n_toxic / (n_toxic + n_clean)
    cells = [(a, (a + c) * share), (c, (a + c) * (1 - share)), (n_toxic - a, (n - a - c) * share), (n_clean - c, (n - a - c) * (1 - share))]
    g = F.lit(0.0)
    for seen, expected in cells:
        g = g + F.when((seen > 0) & (expected > 0), 2 * seen * F.ln(seen / expected)).otherwise(0.0)
    weight = F.ln((a + 0.5) / (n_toxic + 1)) - F.ln((c + 0.5) / (n_clean + 1))
    found = counts.where(a >= LEAST_TOXIC).select("stem", "a", g.alias("g"), weight.alias("weight")).where((F.col("g") >= LEAST_G) & (F.col("weight") >= LEAST_WEIGHT))
    rows = found.orderBy(F.desc("g"), "stem").limit(LEARNED).collect()
    most = {r.stem: r.a for r in rows}
    for r in rows:  # where one longer stem is in as many texts, the shorter one only adds chance
        for k in range(STEM.start, len(r.stem)):
            if most.get(r.stem[:k], 0) * 0.9 <= r.a:
                most.pop(r.stem[:k], None)
    kept: dict[str, float] = {}
    for r in sorted((r for r in rows if r.stem in most), key=lambda r: (len(r.stem), r.stem)):  # a longer stem only where it says more
        shorter = max((kept[r.stem[:k]] for k in range(STEM.start, len(r.stem)) if r.stem[:k] in kept), default=0.0)
        if r.weight > shorter + 0.5:
            kept[r.stem] = float(r.weight)
    return kept


def _counted(both: tuple[Counter, Counter]) -> Iterator[pa.RecordBatch]:
    names = list(both[0].keys() | both[1].keys())
    for at in range(0, len(names), 50_000):
        part = names[at : at + 50_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.string()), pa.array([both[1][x] for x in part], pa.int64()), pa.array([both[0][x] for x in part], pa.int64())],
            names=["stem", "toxic", "clean"])


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> Model:
    """The model learned from the labelled rows outside the held-out fold."""
    bounded_batches(docs.sparkSession)
    train = staged(training_rows(docs, labels, key, text), "toxic-train")
    sizes = {r.toxic: r.n for r in train.groupBy((F.col("toxic") == 1).cast("int").alias("toxic")).agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_clean:
        return Model(dict(SEED_LEXICON), EXCEPTIONS, FIXED_SLOPES)
    lexicon = dict(SEED_LEXICON) | learn_stems(train, n_toxic, n_clean)
    found = score_rows(train, "text", Model(lexicon, EXCEPTIONS, FIXED_SLOPES), "_s")
    rows = found.select("toxic", "_s.log_sum", "_s.log_density", "_s.heaviest").collect()  # at most TRAIN_ROWS
    x = np.array([[r[1], r[2], r[3]] for r in rows])
    return Model(lexicon, EXCEPTIONS, logistic(x, np.array([float(r[0] == 1) for r in rows])))


_SCORE = T.StructType([T.StructField("score", T.DoubleType()), *(T.StructField(n, T.DoubleType()) for n in ("log_sum", "log_density", "heaviest")), T.StructField("n_hits", T.IntegerType())])


def score_rows(df: DataFrame, text: str, model: Model, out: str) -> DataFrame:
    """df and a struct column ``out``: score and evidence of each whole text."""
    bounded_batches(df.sparkSession)
    at = df.columns.index(text)
    arrow = pa.struct([("score", pa.float64()), ("log_sum", pa.float64()), ("log_density", pa.float64()), ("heaviest", pa.float64()), ("n_hits", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = model.automaton()
        b0, *slopes = model.slopes
        for b in batches:
            found = [evidence(x or "", automaton) for x in b.column(at).to_pylist()]
            z = [b0 + sum(s * v for s, v in zip(slopes, f, strict=False)) for f in found]
            score = 1 / (1 + np.exp(-np.clip(np.array(z, float), -40, 40)))
            cols = [score, *(list(zip(*found, strict=True)) or [()] * 4)]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(cols, arrow, strict=True)], fields=list(arrow))],
                names=[*b.schema.names, out])

    return df.mapInArrow(frugal(run, _folding.clear), T.StructType([*df.schema.fields, T.StructField(out, _SCORE)]))


def toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, held_out, score, predicted and n_hits of every row."""
    model = fit(docs, labels, key, text)
    s = F.col("_s")
    return score_rows(docs.select(F.col(key), F.col(text).alias("_t")), "_t", model, "_s").select(
        key, (crc_remainder(F.col(key), HELD_OUT) == 0).alias("held_out"), s["score"].alias("score"),
        (s["score"] >= 0.5).cast("int").alias("predicted"), s["n_hits"].alias("n_hits"))


def keep_clean(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs that are not predicted toxic, with all their columns."""
    model = fit(docs, labels, key, text)
    out = "_toxicity"
    while out in docs.columns:
        out += "_"
    scored = score_rows(docs, text, model, out)
    return scored.where(F.col(f"`{out}`.score") < 0.5).select(*[F.col(f"`{c}`") for c in docs.columns])
