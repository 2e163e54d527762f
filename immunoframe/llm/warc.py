"""WARC archives: a writer through Spark's own file commit, and a salvage reader.

Archives are made of one gzip member per record and written by Spark's text writer into the
shared folder, so a task that is retried on another executor leaves no half file. (A row
is the member without its last byte, NUL, and the line separator is NUL; see ``_member``.)

The reader walks a file member by member; a member holds one record, several, or (with the members that continue it) a part
of one. Field names count in any case and header lines may be folded. Where a member, version line, header, length,
block digest or end mark fails its check, it searches for the next gzip member or ``WARC/1.``
mark, whichever is nearer, that yields a whole record, goes on from there, and
reports the byte range in between as a quarantined gap. No bad byte costs more than the
records it lies in. Header lines are read once for all marks among them, so damage costs time in proportion to its bytes.

A record that is found within the length that a damaged record before it claims is given as ``inner``: it may be a real record
(the claimed length was damaged) or one that the damaged record's payload quotes.

Records of equal payloads are written once: that with the largest page_id is the
``response``; the others are ``revisit`` records that refer to it and carry length and
digest of the full payload in their header.

Defined cases: null html is an empty payload; null urls are written as ``urn:page:<id>``;
a null page_id is kept as an absent ``Page-Id`` header and never a response for others
unless all rows of that payload are null; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, frugal, scratch_path, staged, utf8

VERSION = b"WARC/1.1"
MAGIC = b"\x1f\x8b\x08"
#: Bytes after which a task begins another archive file; one task reads a file whole.
FILE_BYTES = 64 << 20
#: Pages that revisit another, up to which their list is broadcast; a longer one is shuffled with the pages.
BROADCAST_IDS = 1_000_000
#: Bytes of an archive that are inflated at once.
BLOCK = 1 << 16
#: A member that inflates to more is quarantined: Spark holds no larger value in a cell.
MAX_MEMBER_BYTES = (1 << 31) - 1
RECORDS = (
    "file string, at long, end long, inside long, record_type string, headers map<string,string>, payload binary, payload_bytes long, "
    "payload_digest string, inner boolean, gap string")
# Field names of the WARC standard that the reader looks at, under which they are given whatever their case.
FIELDS = {n.lower(): n for n in (
    "WARC-Type", "Content-Length", "WARC-Block-Digest", "WARC-Payload-Digest", "WARC-Record-ID", "WARC-Date", "WARC-Target-URI", "WARC-Refers-To",
    "WARC-Profile", "Content-Type", "WARC-Concurrent-To", "WARC-IP-Address", "WARC-Truncated", "WARC-Warcinfo-ID", "WARC-Filename",
    "WARC-Refers-To-Target-URI", "WARC-Refers-To-Date", "WARC-Identified-Payload-Type", "WARC-Segment-Number", "WARC-Segment-Origin-ID", "WARC-Segment-Total-Length")}


class Found(NamedTuple):
    """One record (gap is empty) or one quarantined byte range (gap says why).

    ``at`` and ``end`` are offsets in the file, of the member where there is one; ``inside`` is the offset in the inflated member.
    """

    at: int
    end: int
    kind: str | None
    headers: dict[str, str] | None
    payload: bytes | None
    gap: str
    inner: bool = False
    inside: int | None = None


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(kind: str, headers: dict[str, str], block: bytes) -> bytes:
    """One uncompressed record with its end mark."""
    clean = lambda v: re.sub(r"[\r\n]", "%0A", str(v))
    head = {"WARC-Type": kind, **headers, "WARC-Block-Digest": f"sha1:{base32_sha1(block)}", "Content-Length": len(block)}
    return VERSION + b"\r\n" + b"".join(f"{k}: {clean(v)}\r\n".encode() for k, v in head.items()) + b"\r\n" + block + b"\r\n\r\n"


def gzip_member(content: bytes, level: int = 6) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(content) + z.flush()


def _member(record: bytes) -> bytes:
    """Gzip of a record, ending in NUL: the last byte of the length field is 0 below 16 MB; larger
    records go in several members, which gzip readers join."""
    step = (1 << 24) - 1
    return b"".join(gzip_member(record[i : i + step]) for i in range(0, len(record), step))


# --- reading -------------------------------------------------------------------------------------

class Damage(ValueError):
    """The check that failed; ``past``: no record begins before that offset; ``claimed``: where the record would have ended."""

    def __init__(self, check: str, past: int, claimed: int = 0):
        super().__init__(check)
        self.past, self.claimed = past, claimed


_VERSION = re.compile(rb"WARC/1\.[0-9]\r?\n")
_LINES = re.compile(rb"(?:[^\r\n:\x20\t][^\r\n:]*+:[^\r\n]*+\r?\n(?:[\x20\t]++[^\r\n]*+\r?\n)*+)*+")
_FOLD = re.compile(rb"\r?\n[\x20\t]+")


def _parse(raw: bytes, at: int = 0) -> tuple[str, dict[str, str], bytes, int]:
    """Type, headers, block and end of the record at ``at``; Damage says which check failed."""
    version = _VERSION.match(raw, at)
    if version is None:
        raise Damage("version line", at + 1)
    head_end = _LINES.match(raw, version.end()).end()
    blank = 2 if raw.startswith(b"\r\n", head_end) else 1 if raw.startswith(b"\n", head_end) else 0
    if not blank:  # the same bad line ends the header of every mark before it
        raise Damage("header line" if head_end < len(raw) else "header end", max(head_end, at + 1))
    headers = {}
    for line in _FOLD.sub(b" ", raw[version.end() : head_end]).splitlines():
        name, _, value = line.partition(b":")
        name = name.decode("utf-8", "replace").strip()
        headers[FIELDS.get(name.lower(), name)] = value.decode("utf-8", "replace").strip()
    start = head_end + blank
    past = max(raw.rfind(b"WARC/1.", at + 1, head_end), at + 1) if b"WARC/1." in raw[version.end() : head_end] else start
    try:
        kind, length = headers["WARC-Type"], int(headers["Content-Length"])
    except (KeyError, ValueError):
        raise Damage("required header", past) from None
    if length < 0:
        raise Damage("required header", past)
    end = start + length
    if end > len(raw) or raw[end : end + 4] != b"\r\n\r\n":
        raise Damage("block length", past, end)
    block = raw[start:end]
    if not _fits(headers.get("WARC-Block-Digest", ""), block):
        raise Damage("block digest", past, end)
    return kind, headers, block, end + 4


def _fits(named: str, block: bytes) -> bool:
    """Whether a sha1 digest, in base 32 or hex, is that of the block; others are not checked."""
    algorithm, _, digest = named.partition(":")
    if algorithm.lower() != "sha1" or len(digest) not in (32, 40):
        return True
    sha = hashlib.sha1(block)
    return digest.upper() == base64.b32encode(sha.digest()).decode() if len(digest) == 32 else digest.lower() == sha.hexdigest()


def _inflate(raw: bytes, at: int) -> tuple[bytes, int]:
    """The inflated member at ``at`` and where it ends, read a block at a time."""
    z, view, out, held, start = zlib.decompressobj(31), memoryview(raw), [], 0, at
    try:
        while not z.eof and at < len(raw):
            piece = view[at : at + BLOCK]
            while True:
                out.append(z.decompress(piece, BLOCK * 16))
                held += len(out[-1])
                if held > MAX_MEMBER_BYTES:
                    raise Damage("member size", start + 1)
                piece = z.unconsumed_tail
                if z.eof or not piece:
                    break
            at = min(at + BLOCK, len(raw))
    except zlib.error as e:
        raise Damage("gzip member", start + 1) from e
    if not z.eof:
        raise Damage("gzip member", start + 1)
    return b"".join(out), at - len(z.unused_data)


def _member_records(raw: bytes, at: int) -> tuple[list[Found], int]:
    """All records and gaps of the member at ``at`` (with the members that continue its last record), and where it ends."""
    out, end = _inflate(raw, at)
    while len(out) % ((1 << 24) - 1) == 0 and raw.startswith(MAGIC, end):  # as the writer cuts long records
        try:
            used = 0
            while used < len(out):
                used = _parse(out, used)[3]
        except Damage as e:
            if str(e) not in ("block length", "header end", "header line"):
                break
            more, end = _inflate(raw, end)
            out += more
            continue
        break
    found = list(_plain(out, None))
    if all(f.gap for f in found):
        raise Damage(found[0].gap if found else "empty member", at + 1)
    return [Found(at, end, f.kind, f.headers, f.payload, f.gap, f.inner, f.at) for f in found], end


#: How a record can begin: with a gzip member or a plain version line.
_MARK = re.compile(rb"\x1f\x8b\x08|WARC/1\.")
_PLAIN_MARK = re.compile(rb"WARC/1\.")


def _plain(raw: bytes, member: Callable[[bytes, int], tuple[list[Found], int]] | None) -> Iterator[Found]:
    """Records and gaps from front to back; ``member`` reads gzip members where there can be any."""
    at, bad_from, why, claimed, mark = 0, -1, "", 0, _MARK if member else _PLAIN_MARK
    while at < len(raw):
        try:
            if member and raw.startswith(MAGIC, at):
                found, end = member(raw, at)
            else:
                kind, headers, block, end = _parse(raw, at)
                found = [Found(at, end, kind, headers, block, "")]
        except Damage as e:
            if bad_from < 0:
                bad_from, why = at, str(e)
            claimed = max(claimed, min(e.claimed, len(raw)))
            following = mark.search(raw, e.past)
            if following is None:
                break
            at = following.start()
            continue
        if bad_from >= 0:
            yield Found(bad_from, at, None, None, None, why)
            bad_from = -1
        for f in found:
            yield f._replace(inner=f.inner or at < claimed) if not f.gap else f
        at = end
    if bad_from >= 0:
        yield Found(bad_from, len(raw), None, None, None, why)


def salvage(raw: bytes) -> Iterator[Found]:
    """All whole records of an archive, gzip, plain or both, and the gaps between them."""
    return _plain(raw, _member_records)


def read_warc(spark: SparkSession, path: str, glob: str | None = None, payloads: bool = True) -> DataFrame:
    """Records and gaps (``gap`` not null) of all archives under path, see RECORDS.

    ``glob`` narrows the archives by file name; folders below path are read too. Without ``payloads`` that column is
    null, its length and digest are still those of the bytes read. A task reads a file whole, which Spark limits to 2 GB.
    """
    bounded_batches(spark)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    files = (reader.option("pathGlobFilter", glob) if glob else reader).load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, raw in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                rows, held = [], 0
                for f in salvage(raw.as_py()):
                    own = f.payload is not None
                    rows.append((
                        name, f.at, f.end, f.inside, f.kind, None if f.headers is None else list(f.headers.items()), f.payload if payloads else None,
                        len(f.payload) if own else None, base32_sha1(f.payload) if own else None, f.inner, f.gap or None))
                    held += len(f.payload or b"") if payloads else 0
                    if len(rows) >= 1000 or held > 8 << 20:
                        yield _rows(rows)
                        rows, held = [], 0
                yield _rows(rows)

    return files.mapInArrow(frugal(run), RECORDS)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    types = [
        pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.map_(pa.string(), pa.string()), pa.binary(), pa.int64(), pa.string(), pa.bool_(), pa.string()]
    columns = list(zip(*rows, strict=True)) or [()] * len(types)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
        names=["file", "at", "end", "inside", "record_type", "headers", "payload", "payload_bytes", "payload_digest", "inner", "gap"],
    )


# --- writing -------------------------------------------------------------------------------------

def plan_records(pages: DataFrame) -> DataFrame:
    """page_id, url, html and the page_id of each payload's response.

    Only (digest, page_id) pairs are grouped, pre-aggregated on the map side. Pages whose payload no other has
    need no join: of digests with several pages, a list of (page_id, response) is joined with the pages by page_id, so no
    payload is dealt by its digest and a payload that a third of the pages share is no hot key.
    """
    digest = F.sha1(F.coalesce(F.col("html").cast("binary"), F.lit(b"")))
    ids = pages.select("page_id", digest.alias("digest"))
    last = ids.groupBy("digest").agg(F.max("page_id").alias("response_id"), F.count("*").alias("k")).where("k > 1").drop("k")
    others = ids.join(last, "digest").where("page_id <> response_id or page_id is null")
    others = staged(others.groupBy("page_id").agg(F.map_from_entries(F.collect_set(F.struct("digest", "response_id"))).alias("to")), "warc-revisits")
    n = others.count()
    own = pages.select("page_id", "url", "html")
    known = F.broadcast(others) if n <= BROADCAST_IDS else others
    joined = own.join(known.withColumnRenamed("page_id", "_id"), own["page_id"].eqNullSafe(F.col("_id")), "left")
    return joined.select("page_id", "url", "html", F.coalesce(F.try_element_at("to", digest), "page_id").alias("response_id"))


def write_warc(pages: DataFrame, path: str) -> None:
    """One record for each page into gzip archives under path, in files of about FILE_BYTES."""
    spark = pages.sparkSession
    bounded_batches(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        written = 0
        for b in batches:
            out, volume = [], []
            for page, url, html, response in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), utf8(b.column(2)), b.column(3).to_pylist(), strict=True):
                headers = {
                    "WARC-Record-ID": f"<urn:page:{page}>", "WARC-Date": "1970-01-01T00:00:00Z",
                    "WARC-Target-URI": url if url is not None else f"urn:page:{page}",
                    "WARC-Payload-Digest": f"sha1:{base32_sha1(html)}", "Payload-Length": len(html),
                }
                if page is not None:
                    headers["Page-Id"] = page
                if page == response:
                    record = record_bytes("response", headers, html)
                else:
                    headers |= {"WARC-Refers-To": f"<urn:page:{response}>", "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"}
                    record = record_bytes("revisit", headers, b"")
                out.append(_member(record)[:-1])
                volume.append(written // FILE_BYTES)
                written += len(out[-1])
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), pa.array(volume, pa.int64())], names=["member", "volume"])

    members = plan_records(pages).select("page_id", "url", "html", "response_id").mapInArrow(frugal(run), "member binary, volume long")
    members.select(F.col("member").cast("string").alias("value"), "volume").write.partitionBy("volume").option("lineSep", "\0").text(path)


def quarantine(records: DataFrame) -> DataFrame:
    """The log of what :func:`read_warc` could not read: file, first byte, end and the check that failed first."""
    return records.where("gap is not null").select("file", "at", "end", "inside", "gap")


def round_trip(pages: DataFrame, log: str | None = None) -> DataFrame:
    """Writes the pages to archives in the shared folder and reads the archives back.

    page_id, payload_bytes, payload_digest, record_type and refers_to of each record. Length and digest of a
    response are worked out anew from the payload read; a revisit has no payload, its headers tell them. The archives are parsed
    once; quarantined gaps go to a table in the folder ``log``, by default one in the shared folder.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_warc(pages, path)
    parsed = staged(read_warc(spark, path, payloads=False).drop("payload"), "warc-records")
    quarantine(parsed).write.mode("overwrite").parquet(log or scratch_path(spark, "warc-quarantine"))
    own = F.col("record_type") == "response"
    h = F.col("headers")
    refers = F.regexp_extract(h["WARC-Refers-To"], r"^<urn:page:(-?\d+)>$", 1)
    return parsed.where("gap is null").select(
        h["Page-Id"].cast("long").alias("page_id"), F.when(own, F.col("payload_bytes")).otherwise(h["Payload-Length"].cast("long")).alias("payload_bytes"),
        F.when(own, F.col("payload_digest")).otherwise(F.substring(h["WARC-Payload-Digest"], 6, 32)).alias("payload_digest"), "record_type",
        F.when(F.col("record_type") == "revisit", refers.cast("long")).alias("refers_to"),
    )
