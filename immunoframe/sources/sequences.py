"""FASTQ, FASTA and SQLite sources as Python data sources, and text-based readers and writers."""

from __future__ import annotations

import gzip
import io
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from ..functions import sequence as S
from ..session import ship_package

SPLIT_BYTES = 64 << 20
#: Records and letters of one Arrow batch.
BATCH_ROWS, BATCH_LETTERS = 5000, 8 << 20
FILE_SHIFT = 40  # read_ord: number of the file, then the byte at which the record starts


class Piece(InputPartition):
    def __init__(self, path: str, number: int, start: int, stop: int):
        self.path, self.number, self.start, self.stop = path, number, start, stop


def _filesystem(path: str):
    from pyarrow import fs

    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


class _Reads(DataSourceReader):
    """Byte ranges of files; a record belongs to the range in which it starts. Gzip files are one range each."""

    suffixes: tuple[str, ...] = ()

    def __init__(self, options: dict):
        self.path, self.split = options["path"], int(options.get("splitBytes", SPLIT_BYTES))

    def partitions(self):
        from pyarrow import fs

        system, path = _filesystem(self.path)
        info = system.get_file_info(path)
        files = [info] if info.is_file else [f for f in system.get_file_info(fs.FileSelector(path, recursive=True)) if f.is_file]
        files = sorted((f for f in files if f.path.removesuffix(".gz").endswith(self.suffixes)), key=lambda f: f.path)
        if not files:
            raise ValueError(f"no {'/'.join(self.suffixes)} file at {self.path}")
        out = []
        for n, f in enumerate(files):
            step = f.size if f.path.endswith(".gz") else self.split
            out += [Piece(f.path, n, at, min(at + step, f.size)) for at in range(0, max(f.size, 1), max(step, 1))]
        return out

    def lines(self, piece: Piece) -> Iterator[tuple[int, bytes]]:
        """Offsets and lines from the first line that starts in the range, on to the file's end."""
        system, _ = _filesystem(self.path)
        raw = system.open_input_file(piece.path)
        if piece.path.endswith(".gz"):
            stream, at = gzip.GzipFile(fileobj=raw), 0
        else:
            at = piece.start
            if at:
                raw.seek(at - 1)
                stream = io.BufferedReader(raw, 1 << 20)
                at += len(stream.readline()) - 1
            else:
                stream = io.BufferedReader(raw, 1 << 20)
        for line in stream:
            yield at, line.rstrip(b"\r\n")
            at += len(line)


class Malformed(ValueError):
    """A FASTQ file has lines that belong to no record."""


class _FastqReader(_Reads):
    """Records as Arrow batches. Lines that belong to no record are dropped, kept as rows without read_id, or an error (``malformed``).

    A row kept for such lines has their number and the first of them as description. The first three lines of a
    range may be the end of a record that begins in the range before, and count as that.
    """

    suffixes = (".fastq", ".fq")

    def __init__(self, options: dict):
        super().__init__(options)
        self.malformed = options.get("malformed", "drop")
        if self.malformed not in ("drop", "keep", "fail"):
            raise ValueError(f"malformed: drop, keep or fail, not {self.malformed}")

    def read(self, piece: Piece):
        return _arrow(self.records(piece), ("read_id", "description", "sequence", "quality"))

    def records(self, piece: Piece) -> Iterator[tuple]:
        held: list[tuple[int, bytes]] = []
        stray: list[tuple[int, bytes]] = []
        whole = piece.path.endswith(".gz")
        spare = 0 if whole or not piece.start else 3

        def lost() -> Iterator[tuple]:
            if stray and self.malformed == "fail":
                raise Malformed(f"{piece.path}: {len(stray)} lines from byte {stray[0][0]} belong to no record")
            if stray and self.malformed == "keep":
                yield None, f"{len(stray)} lines: {stray[0][1].decode(errors='replace')}", None, None, (piece.number << FILE_SHIFT) | stray[0][0]
            stray.clear()

        for item in self.lines(piece):
            held.append(item)
            if len(held) < 4:
                continue
            (at, head), (_, seq), (_, plus), (_, qual) = held
            if not whole and at >= piece.stop:
                yield from lost()
                return
            if head[:1] == b"@" and plus[:1] == b"+" and len(seq) == len(qual):
                yield from lost()
                name, _, rest = head[1:].decode(errors="replace").partition(" ")
                yield name, rest, seq.decode(errors="replace"), qual.decode(errors="replace"), (piece.number << FILE_SHIFT) | at
                held, spare = [], 0
            else:
                gone = held.pop(0)
                if spare:
                    spare -= 1
                elif gone[1]:
                    stray.append(gone)
        stray += [x for x in held[spare:] if x[1] and (whole or x[0] < piece.stop)]
        yield from lost()


class _FastqStream(DataSourceStreamReader):
    """Files that arrive in a folder, moved in whole. An offset is the number of bytes of each file that batches have taken.

    A batch reads the byte ranges between two offsets, so a restart from a checkpoint reads each record once. read_ord has a
    checksum of the file's path in place of its number, which later files would shift.
    """

    def __init__(self, options: dict):
        self.reader = _FastqReader(options)

    def _files(self) -> dict[str, int]:
        from pyarrow import fs

        system, path = _filesystem(self.reader.path)
        found = system.get_file_info(fs.FileSelector(path, recursive=True, allow_not_found=True))
        return {f.path: f.size for f in found if f.is_file and f.path.removesuffix(".gz").endswith(self.reader.suffixes)}

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return self._files()

    def partitions(self, start: dict, end: dict) -> list[Piece]:
        out = []
        for path, size in sorted(end.items()):
            began = start.get(path, 0)
            if size <= began:
                continue
            step = size if path.endswith(".gz") else self.reader.split
            number = zlib.crc32(path.encode()) & 0x3FFFFF
            out += [Piece(path, number, at, min(at + step, size)) for at in range(began, size, max(step, 1))]
        return out

    def read(self, piece: Piece):
        return self.reader.read(piece)

    def commit(self, end: dict) -> None:
        return


def _arrow(rows: Iterator[tuple], texts: tuple[str, ...]) -> Iterator:
    """Rows of texts and read_ord in Arrow batches of bounded rows and letters."""
    import pyarrow as pa

    def batch(held: list[tuple]):
        *columns, order = zip(*held, strict=True)
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.string()) for c in columns), pa.array(order, pa.int64())], names=[*texts, "read_ord"])

    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(x) for x in row[:-1] if x)
        if len(held) >= BATCH_ROWS or size >= BATCH_LETTERS:
            yield batch(held)
            held, size = [], 0
    if held:
        yield batch(held)


class _FastaReader(_Reads):
    suffixes = (".fasta", ".fa")

    def read(self, piece: Piece):
        return _arrow(self.records(piece), ("header", "sequence"))

    def records(self, piece: Piece) -> Iterator[tuple]:
        head, at, parts = None, 0, []
        whole = piece.path.endswith(".gz")
        for pos, line in self.lines(piece):
            if line[:1] == b">":
                if head is not None:
                    yield head, "".join(parts), (piece.number << FILE_SHIFT) | at
                if not whole and pos >= piece.stop:
                    return
                head, at, parts = line[1:].decode(errors="replace"), pos, []
            elif head is not None:
                parts.append(line.decode(errors="replace").strip())
        if head is not None:
            yield head, "".join(parts), (piece.number << FILE_SHIFT) | at


class Fastq(DataSource):
    @classmethod
    def name(cls) -> str:
        return "fastq"

    def schema(self) -> str:
        return "read_id string, description string, sequence string, quality string, read_ord long"

    def reader(self, schema) -> DataSourceReader:
        return _FastqReader(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _FastqStream(self.options)


class Fasta(DataSource):
    @classmethod
    def name(cls) -> str:
        return "fasta"

    def schema(self) -> str:
        return "header string, sequence string, read_ord long"

    def reader(self, schema) -> DataSourceReader:
        return _FastaReader(self.options)


class _SqliteReader(DataSourceReader):
    """Row-id ranges of the barcode index, read in the executors; lengths are filtered in the database."""

    def __init__(self, options: dict):
        self.path, self.rows = options["path"], int(options.get("splitRows", 1_000_000))
        self.table = options.get("table", "spbc_lookup")
        self.lengths = [int(x) for x in options.get("lengths", "").split(",") if x.strip()]

    def _open(self):
        import sqlite3

        return sqlite3.connect(f"file:{self.path}?mode=ro", uri=True)

    def partitions(self):
        with self._open() as db:
            if not db.execute("SELECT 1 FROM sqlite_master WHERE type = 'table' AND name = ?", (self.table,)).fetchone():
                raise ValueError(f"{self.path} has no table {self.table}")
            low, high = db.execute(f"SELECT min(rowid), max(rowid) FROM {self.table}").fetchone()
        if low is None:
            raise ValueError(f"{self.table} is empty")
        return [Piece(self.path, 0, a, min(a + self.rows, high + 1)) for a in range(low, high + 1, self.rows)]

    def read(self, piece: Piece):
        wanted = f" AND raw_spbc_len IN ({','.join(map(str, self.lengths))})" if self.lengths else ""
        with self._open() as db:
            yield from db.execute(
                f"SELECT upper(raw_spbc), spbc_id, x, y, raw_spbc_len, coalesce(read_count, 0) FROM {self.table} WHERE rowid >= ? AND rowid < ?{wanted}", (piece.start, piece.stop))


class BarcodeIndex(DataSource):
    @classmethod
    def name(cls) -> str:
        return "barcode_index"

    def schema(self) -> str:
        return "raw_spbc string, spbc_id string, x int, y int, raw_spbc_len int, read_count long"

    def reader(self, schema) -> DataSourceReader:
        return _SqliteReader(self.options)


def register(spark: SparkSession) -> None:
    """Makes the formats fastq, fasta and barcode_index known to the session."""
    ship_package(spark)
    for source in (Fastq, Fasta, BarcodeIndex):
        spark.dataSource.register(source)


def read_fastq(spark: SparkSession, path: str, **options) -> DataFrame:
    register(spark)
    return spark.read.format("fastq").options(path=path, **options).load()


def stream_fastq(spark: SparkSession, path: str, **options) -> DataFrame:
    """A stream of the records of FASTQ files that arrive in a folder."""
    register(spark)
    return spark.readStream.format("fastq").options(path=path, **options).load()


def read_fasta(spark: SparkSession, path: str, **options) -> DataFrame:
    """read_id, annotations (map), sequence, header and read_ord of each record."""
    register(spark)
    raw = spark.read.format("fasta").options(path=path, **options).load()
    return raw.select(S.header_id(F.col("header")).alias("read_id"), S.header_fields(F.col("header")).alias("annotations"), "sequence", "header", "read_ord")


def read_anchors(spark: SparkSession, path: str) -> DataFrame:
    """anchor_id (the whole header) and seq, in file order."""
    register(spark)
    raw = spark.read.format("fasta").options(path=path).load()
    return raw.select(F.trim("header").alias("anchor_id"), F.upper("sequence").alias("seq"), "read_ord").orderBy("read_ord").drop("read_ord")


def read_whitelist(spark: SparkSession, path: str) -> DataFrame:
    """spbc, x, y of a whitespace-separated list; coordinates where a line has three fields or more, and these must be integers."""
    raw = spark.read.text(path).select(F.split(F.trim("value"), r"\s+").alias("t")).where("t[0] <> ''")
    number = lambda k: F.when(F.size("t") >= 3, F.col("t")[k].cast("int"))  # noqa: E731  not an integer: an error in ANSI mode
    return raw.select(F.col("t")[0].alias("spbc"), number(1).alias("x"), number(2).alias("y"))


def read_sequence_list(spark: SparkSession, path: str) -> DataFrame:
    """seq and ord (0-based place in the file) of a short list, one on each line; blank lines count for nothing."""
    rows = spark.read.text(path, wholetext=True).select(F.posexplode(F.filter(F.split("value", "\n"), lambda v: F.trim(v) != "")).alias("ord", "v"))
    return rows.select(F.split(F.trim("v"), r"\s+")[0].alias("seq"), "ord")


def read_barcode_index(spark: SparkSession, path: str, lengths: list[int] | None = None) -> DataFrame:
    register(spark)
    return spark.read.format("barcode_index").options(path=path, lengths=",".join(map(str, lengths or []))).load()


#: Fixed value: columns of annotated receptor tables.
AIRR_SCHEMA = (
    "sequence_id string, sequence string, rev_comp string, productive string, vj_in_frame string, stop_codon string, locus string, v_call string, d_call string, j_call string, "
    "c_call string, junction string, junction_aa string, junction_length int, consensus_count long, group string, umi string, n_orig long, n_keep long, spbc string, spbcid string, x int, y int, umispbc string, prcount long")


def read_airr(spark: SparkSession, path: str) -> DataFrame:
    """An AIRR table of tab-separated text, columns by name; T and F are booleans, empty is null."""
    raw = spark.read.csv(path, sep="\t", header=True)
    kinds = dict(x.strip().split(" ") for x in AIRR_SCHEMA.split(","))
    flags = ("rev_comp", "productive", "vj_in_frame", "stop_codon")
    cols = [F.when(F.col(c).isin("T", "TRUE", "true"), True).when(F.col(c).isin("F", "FALSE", "false"), False).alias(c) if c in flags else F.col(c).cast(kinds.get(c, "string")).alias(c) for c in raw.columns]
    return raw.select(*cols)


def write_airr(airr: DataFrame, path: str) -> None:
    cols = [F.when(F.col(c), "T").when(~F.col(c), "F").alias(c) if t == "boolean" else F.col(c) for c, t in airr.dtypes]
    airr.select(*cols).write.csv(path, sep="\t", header=True, emptyValue="", nullValue="")


def write_fasta(reads: DataFrame, path: str, header: str = "header", sequence: str = "sequence", by: str | None = None) -> None:
    """Records of two lines each; with ``by`` in a folder for each value."""
    text = reads.select(F.concat(F.lit(">"), F.col(header), F.lit("\n"), F.col(sequence)).alias("value"), *([by] if by else []))
    (text.write.partitionBy(by) if by else text.write).text(path)


def read_spatial_mapping(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("square_002um", "square_016um", "cell_id", "in_cell")


def read_positions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("barcode", "pxl_row_in_fullres", "pxl_col_in_fullres")


def read_scale(spark: SparkSession, path: str) -> float:
    return spark.read.json(path, multiLine=True).first()["tissue_hires_scalef"]
