"""What the operators of this subpackage share: scratch tables, Arrow batch limits, words.

Words are maximal runs of bytes outside ASCII white space (0x20, 0x09-0x0D), which is
what ``bytes.split()`` gives; lower-casing touches A-Z only, as ``bytes.lower()`` does.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import drop_path, drop_staged, scratch_path, shared_dir, staged  # noqa: F401  shared with the operators
from ..session import ship_package

#: Bytes of one Arrow batch handed to Python, so that a batch of very long texts stays small.
BATCH_BYTES = 8 << 20
BATCH_ROWS = 2000


#: Bytes a core reads at once; tables below that for every core are dealt out evenly.
SPREAD_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table; a small one in fewer files than there are cores is dealt to all cores."""
    df, cores = spark.read.parquet(f"{sf_dir}/{name}.parquet"), spark.sparkContext.defaultParallelism
    small = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < SPREAD_BYTES * cores
    return df.repartition(cores) if small and len(df.inputFiles()) < cores else df


def bounded_batches(spark: SparkSession) -> None:
    """Bounds the rows and bytes of Arrow batches for this session, and gives the executors this package."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def ascii_lower(col: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def utf8(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def crc_remainder(key: Column, divisor: int) -> Column:
    """crc32 of the key as text, modulo the divisor; null keys give 0."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % divisor, F.lit(0))


def frugal(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], *caches: Callable[[], object]):
    """run, after which a reused Python worker gives back what it held: the named caches, Arrow's pool and freed memory."""
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_memory_pool(pa.system_memory_pool())
        try:
            yield from run(batches)
        finally:
            for forget in caches:
                forget()
            gc.collect()
            try:
                ctypes.CDLL("libc.so.6").malloc_trim(0)
            except (OSError, AttributeError):  # another C library
                pass

    return wrapped
