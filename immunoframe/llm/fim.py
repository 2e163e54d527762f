"""Fill-in-middle transformation in an Arrow-batched pandas UDF.

A text is cut into units (lines by default). The ends of the units, found by one pass of ``regex.finditer``, lie in
a compact integer array that begins with 0, so "after k units" is the look-up ``ends[k]``: two look-ups give prefix,
middle and suffix as slices. Four draws come from the SHA-256 of seed and key, so the result of a row depends on that
row alone, not on batches, partitions or retries. Prefix, suffix and middle are then laid out as ``psm`` or ``spm`` with sentinels
before the parts; :func:`restore` is the exact inverse.

Defined cases: null text counts as empty; empty texts and texts that hold a sentinel stay ``plain`` (n still counts
their units, the lengths are null); a null key draws as the key ``null``; repeated rows give equal results; an empty table
gives an empty one; a text of one unit may leave prefix, middle or suffix empty; no text is cut or dropped whatever its length;
other columns of the input pass through :func:`fill_in_middle` unseen, whatever their names.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches

LINES = r"[^\n]*\n|[^\n]+"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


class Rule(NamedTuple):
    """seed of the draws; of 100 texts ``rate`` are rearranged, of 100 of those ``spm`` suffix first; the units' pattern."""

    seed: int = 7
    rate: int = 100
    spm: int = 50
    unit: str = LINES


class Parts(NamedTuple):
    n: int
    form: str
    prefix: str
    middle: str
    suffix: str


def draws(seed: int, key: str) -> list[int]:
    """Four unsigned 32-bit draws of a key."""
    digest = hashlib.sha256(f"{seed}:{key}".encode()).digest()
    return [int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12)]


def unit_ends(text: str, unit: regex.Pattern) -> array:
    """0, then the end of each unit in code points."""
    ends = array("q", (0,))
    ends.extend(m.end() for m in unit.finditer(text))
    return ends


def cut(text: str, key: str, rule: Rule) -> Parts:
    """The parts of a text; of a plain one the whole text is the prefix."""
    ends = unit_ends(text, regex.compile(rule.unit))
    n = len(ends) - 1
    h1, h2, h3, h4 = draws(rule.seed, key)
    if not text or h3 % 100 >= rule.rate or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)):
        return Parts(n, "plain", text, "", "")
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = ends[first], ends[second]
    return Parts(n, "spm" if h4 % 100 < rule.spm else "psm", text[:a], text[a:b], text[b:])


def lay_out(p: Parts) -> str:
    if p.form == "psm":
        return f"{PREFIX}{p.prefix}{SUFFIX}{p.suffix}{MIDDLE}{p.middle}"
    if p.form == "spm":
        return f"{SUFFIX}{p.suffix}{PREFIX}{p.prefix}{MIDDLE}{p.middle}"
    return p.prefix


def restore(output: str, form: str) -> str:
    """The text of which ``output`` was made; ValueError if a sentinel is missing or stands out of place."""
    if form == "plain":
        return output
    first, second = {"psm": (PREFIX, SUFFIX), "spm": (SUFFIX, PREFIX)}[form]
    if not output.startswith(first):
        raise ValueError("first sentinel")
    at = output.index(second, len(first))
    end = output.index(MIDDLE, at + len(second))
    one, two, middle = output[len(first) : at], output[at + len(second) : end], output[end + len(MIDDLE) :]
    return one + middle + two if form == "psm" else two + middle + one


_FIELDS = [("n", T.LongType()), ("form", T.StringType()), ("prefix_chars", T.LongType()), ("middle_chars", T.LongType())]


def _hex(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _udf(rule: Rule, texts: bool):
    """Lengths and form, then either the output or the digests of output and restored text."""
    names = ["output"] if texts else ["output_sha256", "restored_sha256"]
    kind = T.StructType([*(T.StructField(n, t) for n, t in _FIELDS), *(T.StructField(n, T.StringType()) for n in names)])

    @F.pandas_udf(kind)
    def transform(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for keys, column in batches:
            rows = []
            for key, text in zip(keys, column, strict=True):
                p = cut(text or "", "null" if key is None else key, rule)
                out, own = lay_out(p), p.form != "plain"
                rows.append((p.n, p.form, len(p.prefix) if own else None, len(p.middle) if own else None,
                             *((out,) if texts else (_hex(out), _hex(restore(out, p.form))))))
            made = pd.DataFrame(rows, columns=kind.names)
            yield made.astype({"n": "int64", "prefix_chars": "Int64", "middle_chars": "Int64"})

    return transform


def _applied(docs: DataFrame, key: str, text: str, rule: Rule, texts: bool) -> Column:
    bounded_batches(docs.sparkSession)
    return _udf(rule, texts)(docs[key].cast("string"), docs[text].cast("string"))


def fill_in_middle(docs: DataFrame, key: str = "doc_id", text: str = "text", rule: Rule = Rule(), out: str = "fim") -> DataFrame:
    """docs and a struct column ``out``: n, form, prefix_chars, middle_chars and output (the rearranged text)."""
    while out in docs.columns:
        out += "_"
    return docs.withColumn(out, _applied(docs, key, text, rule, True))


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text", rule: Rule = Rule()) -> DataFrame:
    """key, n, form, prefix_chars, middle_chars, output_sha256 and restored_sha256 of every row."""
    made = docs.select(docs[key].alias("_k"), _applied(docs, key, text, rule, False).alias("_f"))
    return made.select(F.col("_k").alias(key), "_f.*")
