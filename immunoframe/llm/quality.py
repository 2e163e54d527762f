"""Quality rules: plain limits on word statistics, then robust multivariate outliers.

Every text gives a vector of transformed statistics. For each language and source, location
and scatter are estimated by the minimum covariance determinant (MCD): from several starts (medians
and quartile ranges, all rows, parts of the rows) concentration steps refit mean and covariance to the ``SUPPORT`` share
of rows with the smallest Mahalanobis distances until the determinant falls no more, weak starts being
left after ``TRIAL_STEPS``; that of the least determinant counts. Its covariance is then
scaled to agree with the chi-squared median, refitted once to the rows inside its 97.5 %
ellipsoid (one-step reweighting), and rows beyond the ``CUT`` quantile are rejected.

Each step is one grouped sum over all rows of the narrow statistics table, keyed by group
and distance class (a sixteenth of an octave), with map-side partial sums: a group that holds
a third of all rows costs no task more than its share, and what one task then refits is a
few hundred classes, whatever the number of rows. Sources of fewer than ``MIN_GROUP`` rows
use their language's estimate, languages of so few rows that over everything; where even
that has too few rows nothing more is rejected.

Defined cases: null text counts as empty; an empty text has all statistics 0 and fails the
plain limits; null languages and sources are values of their own; statistics that never
vary (say, no symbols in any text) get the least scatter ``FLOOR``; repeated rows count each
time; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, drop_staged, frugal, staged, utf8

MIN_WORDS = 50
MAX_REPEATED = 50  # per cent of the words
SUPPORT = 0.75
#: Starts of each group; after TRIAL_STEPS the BEST ones with the least determinant go on, to MOST_STEPS at most.
STARTS, BEST = 4, 2
TRIAL_STEPS, MOST_STEPS = 2, 10
#: Fall of the log determinant below which a start has settled.
SETTLED = 1e-3
MIN_GROUP = 40
CUT = 0.99999
SYMBOLS = b"#*$%&|<>"
#: Least standard deviation of each transformed statistic.
FLOOR = (0.05, 0.04, 0.06, 0.05, 0.05, 0.05)
FEATURES = ("f_word", "f_symbol", "f_dup", "f_repeat", "f_upper", "f_punct")
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_STATS = T.StructType([*(T.StructField(n, T.LongType()) for n in BASE), *(T.StructField(n, T.DoubleType()) for n in FEATURES)])
_PUNCT = bytes(c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,")
_UPPER = bytes(range(65, 91))
_SPACE = b" \t\n\r\x0b\x0c"
_CONTINUATION = bytes(range(0x80, 0xC0))  # of UTF-8; without them a byte is a code point


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window which the text holds at least twice."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    hit = np.zeros(len(words), bool)
    at = np.flatnonzero(np.fromiter((counts[w] > 1 for w in windows), bool, len(windows)))
    for k in range(3):
        hit[at + k] = True
    return int(hit.sum())


def text_stats(text: bytes) -> tuple:
    """The base statistics and the transformed vector of one text."""
    words = text.split()
    n = len(words)
    if not n:
        return (0, 0, len(text) - len(text.translate(None, SYMBOLS)), 0, 0, *([0.0] * len(FEATURES)))
    solid = text.translate(None, _SPACE)
    chars = len(solid.translate(None, _CONTINUATION))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [x for x in text.split(b"\n") if x.strip()]
    dup = len(lines) - len(set(lines))
    repeat = repeated_words(words)
    upper = len(solid) - len(solid.translate(None, _UPPER))
    punct = len(solid) - len(solid.translate(None, _PUNCT))
    vector = (np.log(chars / n), np.sqrt(symbols / chars), dup / (len(lines) + 8), repeat / (n + 50), np.sqrt(upper / chars), np.sqrt(punct / chars))
    return (n, chars, symbols, dup, repeat, *map(float, vector))


def with_stats(df: DataFrame, text: str, out: str) -> DataFrame:
    """df and a struct column ``out`` of each text's statistics."""
    bounded_batches(df.sparkSession)
    at = df.columns.index(text)
    arrow = pa.struct([*((n, pa.int64()) for n in BASE), *((n, pa.float64()) for n in FEATURES)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [text_stats(x) for x in utf8(b.column(at))]
            cols = list(zip(*rows, strict=True)) or [()] * arrow.num_fields
            stats = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(cols, arrow, strict=True)], fields=list(arrow))
            yield pa.RecordBatch.from_arrays([*b.columns, stats], names=[*b.schema.names, out])

    return df.mapInArrow(frugal(run), T.StructType([*df.schema.fields, T.StructField(out, _STATS)]))


def base_failed(n_words: Column, n_repeat: Column) -> Column:
    return (n_words < MIN_WORDS) | (100 * n_repeat > MAX_REPEATED * n_words)


# --- the estimate ----------------------------------------------------------------------------------

def chi2(p: float, d: int) -> float:
    """Quantile of the chi-squared distribution (Wilson-Hilferty)."""
    return d * (1 - 2 / (9 * d) + NormalDist().inv_cdf(p) * (2 / (9 * d)) ** 0.5) ** 3


def distance(mean: Column, precision: Column) -> Column:
    """Squared Mahalanobis distance of the feature columns; precision is its upper triangle, row by row."""
    x = [F.col(f) - mean[i] for i, f in enumerate(FEATURES)]
    terms, k = [], 0
    for i in range(len(x)):
        for j in range(i, len(x)):
            terms.append(x[i] * x[j] * precision[k] * (1 if i == j else 2))
            k += 1
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return F.when(total < 0, 0.0).otherwise(total)


def _triangle(matrix: np.ndarray) -> list[float]:
    return [float(matrix[i, j]) for i in range(len(matrix)) for j in range(i, len(matrix))]


def refit(n: float, sums: np.ndarray, products: np.ndarray) -> tuple[list[float], list[float], float]:
    """Mean, precision and log determinant of the covariance from n, the sums and the upper triangle of product sums of some rows."""
    d = len(sums)
    mean = sums / n
    cov = np.zeros((d, d))
    cov[np.triu_indices(d)] = products / n
    cov = np.triu(cov) + np.triu(cov, 1).T - np.outer(mean, mean) + np.diag(np.square(FLOOR))
    return [float(v) for v in mean], _triangle(np.linalg.inv(cov)), float(np.linalg.slogdet(cov)[1])


_FIT = "grp string, start int, mean array<double>, precision array<double>, logdet double"


def _fitted(rows: pd.DataFrame, n: float, s: np.ndarray, p: np.ndarray) -> pd.DataFrame:
    mean, precision, logdet = refit(n, s, p)
    return pd.DataFrame({"grp": [rows["grp"].iloc[0]], "start": [int(rows["start"].iloc[0])], "mean": [mean], "precision": [precision], "logdet": [logdet]})


def _step(classes: pd.DataFrame, last: bool) -> pd.DataFrame:
    """One step from the sums of one start's distance classes (a bounded number of rows)."""
    d = len(FEATURES)
    c = classes.sort_values("cls")
    n = c["n"].to_numpy(float)
    total, upto = n.sum(), np.cumsum(n)
    cls = c["cls"].to_numpy(float)
    if last:  # consistency with the chi-squared median, then one-step reweighting
        middle = 2 ** ((cls[np.searchsorted(upto, total / 2)] + 0.5) / 16)
        factor = max(middle / chi2(0.5, d), 1e-3)
        keep = cls <= np.floor(16 * np.log2(chi2(0.975, d) * factor))
        if n[keep].sum() < total / 2:
            keep = upto <= max(total * SUPPORT, upto[0])
    else:
        keep = np.arange(len(n)) <= np.searchsorted(upto, SUPPORT * total)
    return _fitted(classes, n[keep].sum(), np.array(c["s"].tolist())[keep].sum(axis=0), np.array(c["p"].tolist())[keep].sum(axis=0))


def _concentrate(classes: pd.DataFrame) -> pd.DataFrame:
    return _step(classes, False)


def _concentrate_last(classes: pd.DataFrame) -> pd.DataFrame:
    return _step(classes, True)


def group_keys(stats: DataFrame, by: list[str]) -> DataFrame:
    """For each language and source: grp, whose estimate it uses (or null), and feeds, to which its rows count.

    A source of too few rows uses its language's estimate over all sources, a language of too
    few rows the estimate over everything.
    """
    own = _named(stats.where(~F.col("base_failed")), by).groupBy("_lang", "_source").agg(F.count("*").alias("n"))
    langs = own.groupBy("_lang").agg(F.sum("n").alias("n_lang"), F.min("n").alias("least"))
    total = langs.agg(F.coalesce(F.sum("n_lang"), F.lit(0)).alias("n_all"), F.coalesce(F.min("n_lang"), F.lit(0)).alias("least_lang")).first()
    keyed = own.join(langs, "_lang").withColumns({k: F.lit(total[k]) for k in ("n_all", "least_lang")})
    name = F.concat_ws("\x00", "_lang", "_source")
    grp = F.when(F.col("n") >= MIN_GROUP, name).when(F.col("n_lang") >= MIN_GROUP, F.col("_lang")).when(F.col("n_all") >= MIN_GROUP, F.lit(""))
    feeds = F.array(
        F.when(F.col("n") >= MIN_GROUP, name),
        F.when((F.col("least") < MIN_GROUP) & (F.col("n_lang") >= MIN_GROUP), F.col("_lang")),
        F.when((F.col("least_lang") < MIN_GROUP) & (F.col("n_all") >= MIN_GROUP), F.lit("")),
    )
    return keyed.select("_lang", "_source", grp.alias("grp"), F.filter(feeds, lambda g: g.isNotNull()).alias("feeds"))


def _named(df: DataFrame, by: list[str]) -> DataFrame:
    lang, source = by
    return df.withColumns({
        "_lang": F.coalesce(F.concat(F.lit("="), F.col(lang).cast("string")), F.lit("-")),
        "_source": F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("-")),
    })


def fit(stats: DataFrame, by: list[str]) -> DataFrame:
    """_lang, _source, mean, precision: the MCD estimate that each language and source uses.

    stats has the by columns, the features and base_failed; it is read once for each step.
    """
    keys = staged(group_keys(stats, by), "mcd-keys")
    rows = _named(stats.where(~F.col("base_failed")), by).join(keys, ["_lang", "_source"]).select(F.explode("feeds").alias("grp"), *FEATURES)
    d = len(FEATURES)
    sums = F.array(*[F.sum(f) for f in FEATURES])
    products = F.array(*[F.sum(F.col(FEATURES[i]) * F.col(FEATURES[j])) for i in range(d) for j in range(i, d)])
    facts = [F.count("*").alias("n"), sums.alias("s"), products.alias("p")]
    now = staged(_starts(rows, facts).withColumn("settled", F.lit(False)), "mcd-0")

    def step(fits: DataFrame, how) -> DataFrame:
        at = F.floor(16 * F.log2(distance(F.col("mean"), F.col("precision")) + 1e-6)).cast("int")
        classes = rows.join(fits.select("grp", "start", "mean", "precision"), "grp").withColumn("cls", at).groupBy("grp", "start", "cls").agg(*facts)
        return classes.groupBy("grp", "start").applyInPandas(how, _FIT)

    for k in range(1, MOST_STEPS + 1):
        new = step(now.where("not settled"), _concentrate).select("grp", "start", F.struct("mean", "precision", "logdet").alias("new"))
        better = F.coalesce(F.col("new")["logdet"] < F.col("logdet") - SETTLED, F.lit(False))
        pick = lambda c, better=better: F.when(better, F.col("new")[c]).otherwise(F.col(c)).alias(c)
        merged = now.join(new, ["grp", "start"], "left").select("grp", "start", pick("mean"), pick("precision"), pick("logdet"), (~better).alias("settled"))
        if k == TRIAL_STEPS:  # at most STARTS rows of each group meet
            merged = merged.withColumn("_r", F.row_number().over(W.partitionBy("grp").orderBy("logdet", "start"))).where(F.col("_r") <= BEST).drop("_r")
        before, now = now, staged(merged, f"mcd-{k}")
        drop_staged(before)
        if not now.where("not settled").take(1):
            break
    least = now.groupBy("grp").agg(F.min_by(F.struct("start", "mean", "precision"), F.struct("logdet", "start")).alias("f")).select("grp", "f.*")
    final = staged(step(least, _concentrate_last), "mcd")
    drop_staged(now)
    return keys.drop("feeds").join(final.select("grp", "mean", "precision"), "grp", "left").select("_lang", "_source", "mean", "precision")


def _starts(rows: DataFrame, facts: list[Column]) -> DataFrame:
    """Of each group the medians with quartile spreads, and mean and covariance of all rows and of two eighths dealt by a hash."""
    d = len(FEATURES)
    quartiles = [F.percentile_approx(f, [0.25, 0.5, 0.75], 1000).alias(f"q{i}") for i, f in enumerate(FEATURES)]

    def robust(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for r in b.itertuples(index=False):
                q = np.array([list(getattr(r, f"q{i}")) for i in range(d)])
                spread = np.square((q[:, 2] - q[:, 0]) / 1.349) + np.square(FLOOR)
                out.append((r.grp, 0, [float(v) for v in q[:, 1]], _triangle(np.diag(1 / spread)), float("inf")))
            yield pd.DataFrame(out, columns=["grp", "start", "mean", "precision", "logdet"])

    def plain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for i in range(len(b)):
                r = b.iloc[i : i + 1]
                yield _fitted(r, float(r["n"].iloc[0]), np.array(list(r["s"].iloc[0])), np.array(list(r["p"].iloc[0]))).assign(logdet=float("inf"))

    eighth = F.pmod(F.xxhash64(*FEATURES), F.lit(8))
    subsets = F.array(F.lit(1), *[F.when(eighth == k, F.lit(k)) for k in range(2, STARTS)])
    some = rows.withColumn("start", F.explode(F.filter(subsets, lambda x: x.isNotNull()))).groupBy("grp", "start").agg(*facts)
    return rows.groupBy("grp").agg(*quartiles).mapInPandas(robust, _FIT).unionByName(some.mapInPandas(plain, _FIT))


def judge(stats: DataFrame, fitted: DataFrame, by: list[str]) -> DataFrame:
    """stats with ``d2`` (squared distance; null without an estimate) and ``kept``."""
    far = distance(F.col("mean"), F.col("precision"))
    joined = _named(stats, by).join(fitted, ["_lang", "_source"], "left")
    return joined.withColumn("d2", far).withColumn(
        "kept", ~F.col("base_failed") & F.coalesce(F.col("d2") <= chi2(CUT, len(FEATURES)), F.lit(True))
    ).drop("_lang", "_source", "mean", "precision")


def _flat(df: DataFrame, out: str, keep: list[str]) -> DataFrame:
    s = F.col(f"`{out}`")
    return df.select(*keep, *(s[n].alias(n) for n in (*BASE, *FEATURES)), base_failed(s["n_words"], s["n_repeat_words"]).alias("base_failed"))


def quality_rules(docs: DataFrame, key: str = "doc_id", text: str = "text", by: tuple[str, str] = ("lang", "source")) -> DataFrame:
    """key, the base statistics, base_failed, kept and the distance of every row."""
    own = docs.select(F.col(key).alias(key), F.col(text).alias("_t"), *by)
    stats = staged(_flat(with_stats(own, "_t", "_q"), "_q", [key, *by]), "quality")
    judged = judge(stats, fit(stats, list(by)), list(by))
    return judged.select(key, *BASE, "base_failed", "kept", F.round("d2", 4).alias("distance2"))


def keep_good(docs: DataFrame, text: str = "text", by: tuple[str, str] = ("lang", "source")) -> DataFrame:
    """The rows of docs that the rules keep, with all their columns.

    The texts are read twice (to fit and to judge) instead of being shuffled or stored.
    """
    own = docs.select(F.col(text).alias("_t"), *by)
    stats = staged(_flat(with_stats(own, "_t", "_q"), "_q", list(by)), "quality")
    fitted = staged(fit(stats, list(by)), "mcd")
    out = "_quality"
    while out in docs.columns:
        out += "_"
    seen = with_stats(docs, text, out)
    s = F.col(f"`{out}`")
    lang, source = by
    names = {
        "_l": F.coalesce(F.concat(F.lit("="), F.col(lang).cast("string")), F.lit("-")),
        "_s": F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("-")),
    }
    packed = seen.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), *(s[f].alias(f) for f in FEATURES), base_failed(s["n_words"], s["n_repeat_words"]).alias("base_failed"), *(c.alias(n) for n, c in names.items()))
    joined = packed.join(fitted, (F.col("_l") == F.col("_lang")) & (F.col("_s") == F.col("_source")), "left")
    far = distance(F.col("mean"), F.col("precision"))
    good = joined.where(~F.col("base_failed") & F.coalesce(far <= chi2(CUT, len(FEATURES)), F.lit(True)))
    return good.select(*[F.col("_row")[c].alias(c) for c in docs.columns])
