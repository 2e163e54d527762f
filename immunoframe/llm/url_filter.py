"""URL rules in a memory-mapped, sorted array of 64-bit xxhash digests.

A rule is (verdict, host, path): it fits its host and all subdomains, for paths that
begin with its path; of the fitting rules the longest (host plus path) wins, on a tie
the longer host. The digests of ``host path`` are stored sorted beside the full
strings. A batch of urls is judged at once: every (host suffix, path prefix) pair whose
path length occurs among the rules is hashed, one binary search probes all of them, and
each digest found is confirmed against the stored string, so a collision never decides.

The file goes to the executors with ``SparkContext.addFile``, which also serves executors
that join later; workers map it read-only. Rules of more than ``MAX_INDEX_BYTES`` are
joined by a shuffle instead (:func:`judge_by_join`), with the same result.

Defined cases: a null url or one without ``://`` has empty host and path, fits no rule and
gets the default verdict; an empty rule list leaves every url at the default; repeated
rules count once (the first wins); an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, bounded_batches

MAX_INDEX_BYTES = 256 << 20
Rule = tuple[str, str, str]


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def digest(host: str, path: str) -> int:
    return xxhash.xxh64_intdigest(f"{host}{path}".encode())


class DigestIndex:
    """Sorted digests, offsets, and the strings ``verdict\\0host\\0path`` they stand for, in one mapped file."""

    def __init__(self, path: str):
        head = np.memmap(path, dtype="<i8", mode="r", shape=(2,))
        n, n_lengths = map(int, head)
        at = 16
        self.keys = np.memmap(path, dtype="<u8", mode="r", offset=at, shape=(n,)) if n else np.empty(0, "<u8")
        at += 8 * n
        self.offsets = np.memmap(path, dtype="<i8", mode="r", offset=at, shape=(n + 1,))
        at += 8 * (n + 1)
        lengths = np.memmap(path, dtype="<i8", mode="r", offset=at, shape=(n_lengths,)) if n_lengths else []
        self.path_lengths = sorted(map(int, lengths))
        at += 8 * n_lengths
        self.strings = np.memmap(path, dtype="u1", mode="r", offset=at)

    def rule(self, at: int) -> Rule:
        verdict, host, path = bytes(self.strings[self.offsets[at] : self.offsets[at + 1]]).decode().split("\0")
        return verdict, host, path

    def judge(self, hosts: list[str], paths: list[str]) -> list[Rule | None]:
        """The longest fitting rule of each (host, path), or None."""
        best: list[Rule | None] = [None] * len(hosts)
        if not len(self.keys):
            return best
        owner, wanted, digests = [], [], []
        for i, (host, path) in enumerate(zip(hosts, paths, strict=True)):
            if not host:
                continue
            labels = host.split(".")
            for k in range(len(labels)):
                suffix = ".".join(labels[k:])
                for n in self.path_lengths:
                    if n > len(path):
                        break
                    owner.append(i)
                    wanted.append((suffix, path[:n]))
                    digests.append(digest(suffix, path[:n]))
        if not digests:
            return best
        probe = np.array(digests, "<u8")
        first = np.searchsorted(self.keys, probe)
        for at in np.flatnonzero(self.keys[np.minimum(first, len(self.keys) - 1)] == probe):
            k = int(first[at])
            while k < len(self.keys) and self.keys[k] == probe[at]:  # all strings under one digest
                found = self.rule(k)
                if found[1:] == wanted[at]:
                    i = owner[at]
                    rank = lambda r: (len(r[1]) + len(r[2]), len(r[1]))
                    if best[i] is None or rank(found) > rank(best[i]):
                        best[i] = found
                    break
                k += 1
        return best


def index_bytes(rules: Iterable[Rule]) -> bytes:
    """The file that :class:`DigestIndex` maps; of equal (host, path) pairs the first rule stays."""
    own: dict[tuple[str, str], str] = {}
    for verdict, host, path in rules:
        own.setdefault((host, path), verdict)
    rows = sorted((digest(h, p), f"{v}\0{h}\0{p}".encode()) for (h, p), v in own.items())
    lengths = sorted({len(p) for _, p in own})
    offsets = np.cumsum([0, *(len(x) for _, x in rows)])
    return b"".join([
        np.array([len(rows), len(lengths)], "<i8").tobytes(), np.array([k for k, _ in rows], "<u8").tobytes(),
        offsets.astype("<i8").tobytes(), np.array(lengths, "<i8").tobytes(), *(x for _, x in rows), b"\0",
    ])


_shipped: set[tuple[str, str]] = set()


def ship(spark: SparkSession, content: bytes) -> str:
    """Serves the index to all executors, once for each application; its name is its content's hash."""
    name = f"urls-{hashlib.sha256(content).hexdigest()[:24]}.idx"
    if (spark.sparkContext.applicationId, name) in _shipped:
        return name
    _shipped.add((spark.sparkContext.applicationId, name))
    path = os.path.join(tempfile.mkdtemp(), name)
    with open(path, "wb") as out:
        out.write(content)
    spark.sparkContext.addFile(path)
    return name


def judge_urls(df: DataFrame, key: str, url: str, rules: Iterable[Rule], default: str = "allow") -> DataFrame:
    """key, host, path, rule (host plus path; null if none fits) and verdict of each row's url."""
    spark = df.sparkSession
    rules = list(rules)
    parts = df.select(F.col(key), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    content = index_bytes(rules)
    if len(content) > MAX_INDEX_BYTES:
        return judge_by_join(parts, key, spark.createDataFrame([(n, *r) for n, r in enumerate(rules)], "n long, verdict string, host string, path string"), default)
    bounded_batches(spark)
    name = ship(spark, content)
    schema = parts.select("*", F.lit("").alias("rule"), F.lit("").alias("verdict")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = DigestIndex(SparkFiles.get(name))
        for b in batches:
            found = index.judge(b.column(1).to_pylist(), b.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([f[1] + f[2] if f else None for f in found], pa.string()),
                 pa.array([f[0] if f else default for f in found], pa.string())],
                names=[key, "host", "path", "rule", "verdict"],
            )

    for field in schema:
        field.nullable = True
    return parts.mapInArrow(run, schema)


def judge_by_join(parts: DataFrame, key: str, rules: DataFrame, default: str) -> DataFrame:
    """The same verdicts by an equality join of candidate strings, for rule tables of any size.

    Of rules that repeat host and path the first counts, as in the index: that with the least ``n`` where rules have such a column,
    else the verdict that sorts first.
    """
    lengths = sorted(r[0] for r in rules.select(F.length("path")).distinct().collect())  # a path has bounded length
    order = F.col("n") if "n" in rules.columns else F.col("verdict")
    first = rules.groupBy("host", "path").agg(F.min_by("verdict", order).alias("verdict"))
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    prefixes = F.filter(F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths]), lambda p: p.isNotNull())
    each = parts.select("host", "path").where("host <> ''").distinct()  # told apart by what is judged: a number of the row may differ between two readings
    wanted = each.select("host", "path", F.explode(suffixes).alias("h"), prefixes.alias("ps")).select("host", "path", "h", F.explode("ps").alias("p"))
    rank = F.struct((F.length("h") + F.length("p")).alias("n"), F.length("h").alias("m"))
    rule = first.select(F.col("host").alias("h"), F.col("path").alias("p"), "verdict")
    best = wanted.join(rule, ["h", "p"]).groupBy("host", "path").agg(F.max_by(F.struct(F.concat("h", "p").alias("rule"), "verdict"), rank).alias("won"))
    return parts.join(best, ["host", "path"], "left").select(
        key, "host", "path", F.col("won.rule").alias("rule"), F.coalesce("won.verdict", F.lit(default)).alias("verdict"))
