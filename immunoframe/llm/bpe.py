"""Byte-level BPE with content-defined chunk reuse.

A text is cut where a rolling hash of its last 16 bytes says so, so equal passages of
different documents give equal chunks wherever they stand. Each chunk is encoded once and
its ids are reused from a cache of bounded size (in each Python worker: chunks of other
workers are encoded there again, which keeps texts out of any shuffle). Ids at a chunk's
edges may differ from those of the whole text, so each join is repaired: the stretch between
the nearest places at which a pre-token surely ends (a visible ASCII character followed by
ASCII white space, which no pre-token spans) is encoded again, and is widened until both of its
ends are token ends of the chunks it meets. What lies between repairs stands as it was.

Merges run in ``tiktoken`` when the file's merges are in id order, else in ``tokenizers``.
Special tokens in a text are cut out first, as ``tokenizers`` does.

Defined cases: null text is the empty text, which has no ids; texts of any length are encoded
whole; bytes that are not UTF-8 are replaced by U+FFFD first; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, frugal, utf8

#: Mean, least and largest bytes of a chunk; bytes that one worker's cache may hold.
MEAN_CHUNK = 512
LEAST_CHUNK = 64
MOST_CHUNK = 16_384
CACHE_BYTES = 24 << 20

_rng = np.random.default_rng(20240229)
_GEAR = _rng.integers(0, 1 << 32, 256, dtype=np.uint32)
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_VISIBLE = np.zeros(256, bool)
_VISIBLE[0x21:0x7F] = True

#: Fixed value: the pattern by which byte-level vocabularies split text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in vocabulary files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def cuts(text: np.ndarray) -> list[int]:
    """Ends of the chunks of a text (as bytes), but for the last."""
    n = len(text)
    if n <= LEAST_CHUNK:
        return []
    h = _GEAR[text]
    for k in (1, 2, 4, 8):  # h[i] sums the last 2k bytes' numbers, each shifted by its age
        older = h[:-k] << np.uint32(k)
        h[k:] += older
    places = np.flatnonzero((h & np.uint32(MEAN_CHUNK - 1)) == 0) + 1
    out, last = [], 0
    for p in [*places.tolist(), n]:
        while p - last > MOST_CHUNK:
            last = _whole(text, last + MOST_CHUNK)
            if last >= n:
                return out
            out.append(last)
        if p < n and p - last >= LEAST_CHUNK and (q := _whole(text, p)) < n:
            out.append(q)
            last = q
    return out


def _whole(text: np.ndarray, p: int) -> int:
    """The first start of a character at or after p."""
    while p < len(text) and text[p] & 0xC0 == 0x80:
        p += 1
    return p


class Codec:
    """Encoder and decoder of one tokenizer file, with its chunk cache."""

    def __init__(self, path: str, cache_bytes: int = CACHE_BYTES):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, letters = spec["model"], byte_letters()
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        as_bytes = lambda token: bytes(letters[c] for c in token)
        ranks = {as_bytes(t): i for t, i in model["vocab"].items() if t not in self.specials}
        self.token_bytes = [b""] * (max([*ranks.values(), *self.specials.values()]) + 1)
        for b, i in ranks.items():
            self.token_bytes[i] = b
        for s, i in self.specials.items():
            self.token_bytes[i] = s.encode()
        self.lengths = np.array([len(b) for b in self.token_bytes], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        in_order = all(model["vocab"].get(a + b) == 256 + i for i, (a, b) in enumerate(pairs))
        if in_order and spec["normalizer"] is None and not spec["pre_tokenizer"].get("add_prefix_space"):
            import tiktoken

            core = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
            self._merge = lambda text: np.array(core.encode_ordinary(text), np.uint32)
        else:
            from tokenizers import Tokenizer

            own = Tokenizer.from_file(path)
            own.no_truncation()
            own.no_padding()
            own.encode_special_tokens = True
            self._merge = lambda text: np.array(own.encode(text, add_special_tokens=False).ids, np.uint32)
        self._special = re.compile("|".join(map(re.escape, sorted(self.specials, key=len, reverse=True)))) if self.specials else None
        self._cache: dict[bytes, tuple[np.ndarray, np.ndarray]] = {}
        self._held, self._most = 0, cache_bytes
        self.hits = self.misses = self.repairs = 0

    def _chunk(self, chunk: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a chunk and the byte at which each token ends."""
        got = self._cache.get(chunk)
        if got is not None:
            self.hits += 1
            return got
        self.misses += 1
        ids = self._merge(chunk.decode())
        got = (ids, np.cumsum(self.lengths[ids]))
        self._cache[chunk] = got
        self._held += len(chunk) + 12 * len(ids) + 400
        while self._held > self._most and len(self._cache) > 1:  # the oldest goes first
            old = next(iter(self._cache))
            self._held -= len(old) + 12 * len(self._cache.pop(old)[0]) + 400
        return got

    def _segment(self, raw: bytes) -> list[np.ndarray]:
        """Ids of a stretch without special tokens, in pieces."""
        text = np.frombuffer(raw, np.uint8)
        inner = cuts(text)
        if not inner:
            return [self._chunk(raw)[0]] if raw else []
        edges = [0, *inner, len(raw)]
        chunks = [self._chunk(raw[a:b]) for a, b in zip(edges, edges[1:], strict=False)]
        sure = np.flatnonzero(_WHITE[text[1:]] & _VISIBLE[text[:-1]]) + 1
        sure = np.concatenate([[0], sure, [len(raw)]])
        ends = [c[1] + e for c, e in zip(chunks, edges, strict=False)]

        def token_end(p: int) -> bool:
            """Whether the chunk around p (or the one that ends there) has a token end at p."""
            k = int(np.searchsorted(edges, p))
            if edges[k] == p:
                return True
            at = int(np.searchsorted(ends[k - 1], p))
            return at < len(ends[k - 1]) and int(ends[k - 1][at]) == p

        windows: list[list[int]] = []
        for c in inner:
            k = int(np.searchsorted(sure, c))
            if sure[k] == c:
                continue  # the join is itself a sure place
            lo, hi = k - 1, k
            while lo > 0 and not token_end(int(sure[lo])):
                lo -= 1
            while hi < len(sure) - 1 and not token_end(int(sure[hi])):
                hi += 1
            a, b = int(sure[lo]), int(sure[hi])
            if windows and a < windows[-1][1]:
                windows[-1][1] = max(b, windows[-1][1])
            else:
                windows.append([a, b])
        self.repairs += len(windows)
        out, at = [], 0
        for a, b in [*windows, [len(raw), len(raw)]]:
            k = int(np.searchsorted(edges, at, side="right")) - 1
            while at < a:  # chunk ids stand between the repairs
                stop = min(a, edges[k + 1])
                i = int(np.searchsorted(ends[k], at, side="right")) if at > edges[k] else 0
                j = int(np.searchsorted(ends[k], stop, side="right"))
                out.append(chunks[k][0][i:j])
                at, k = stop, k + 1
            if a < b:
                out.append(self._merge(raw[a:b].decode()))
                at = b
        return out

    def encode(self, raw: bytes) -> np.ndarray:
        """All ids of a whole text given as UTF-8."""
        parts: list[np.ndarray] = []
        if self._special is None:
            parts = self._segment(raw)
        else:
            text = None
            if any(s.encode() in raw for s in self.specials):
                text = raw.decode()
                at = 0
                for m in self._special.finditer(text):
                    parts += self._segment(text[at : m.start()].encode())
                    parts.append(np.array([self.specials[m[0]]], np.uint32))
                    at = m.end()
                parts += self._segment(text[at:].encode())
            else:
                parts = self._segment(raw)
        return np.concatenate(parts).astype("<u4") if parts else np.empty(0, "<u4")

    def forget(self) -> None:
        self._cache.clear()
        self._held = 0

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids, special tokens included."""
        return b"".join(map(self.token_bytes.__getitem__, ids.tolist())).decode("utf-8", "replace")


_codecs: dict[str, Codec] = {}


def forget_chunks() -> None:
    """Empties the chunk caches of this process."""
    for c in _codecs.values():
        c.forget()


def codec(path: str) -> Codec:
    """This process's codec of a file."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def encode_rows(docs: DataFrame, text: str = "text", path: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns, the ids of each text and the text decoded from them."""
    spark = docs.sparkSession
    bounded_batches(spark)
    path = path or default_path()
    keep = keep or [c for c in docs.columns if c != text]
    own = docs.select(*keep, F.col(text).alias("_t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in batches:
            ids = [c.encode(_valid(x)) for x in utf8(b.column(len(keep)))]
            flat = np.concatenate([*ids, np.empty(0, "<u4")]).astype(np.int32)
            offsets = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[: len(keep)], pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), pa.array(map(c.decode, ids), pa.string())],
                names=[*keep, "ids", "decoded"])

    return own.mapInArrow(frugal(run, forget_chunks), ", ".join([*(f"`{n}` {t}" for n, t in own.dtypes[: len(keep)]), "ids array<int>", "decoded string"]))


def _valid(raw: bytes) -> bytes:
    try:
        raw.decode()
        return raw
    except UnicodeDecodeError:
        return raw.decode("utf-8", "replace").encode()


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """key, n_tokens, ids_sha256 and decoded_sha256 of every row, digested where the ids are made."""
    bounded_batches(docs.sparkSession)
    path = path or default_path()
    own = docs.select(F.col(key), F.col(text).alias("_t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in batches:
            n, ids_sha, text_sha = [], [], []
            for x in utf8(b.column(1)):
                ids = c.encode(_valid(x))
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(ids.tobytes()).hexdigest())
                text_sha.append(hashlib.sha256(c.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                names=[key, "n_tokens", "ids_sha256", "decoded_sha256"])

    return own.mapInArrow(frugal(run, forget_chunks), f"`{key}` {own.dtypes[0][1]}, n_tokens long, ids_sha256 string, decoded_sha256 string")
