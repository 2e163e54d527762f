"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Spark's setting that removes the shuffle files of a query at its end.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
COALESCE = "spark.sql.adaptive.coalescePartitions.enabled"

_made: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a temporary folder only where that is unset and the master is local."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = f"file://{tempfile.mkdtemp(prefix='immunoframe-')}"
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; removed when the driver ends."""
    top = f"{shared_dir(spark)}/immunoframe-{spark.sparkContext.applicationId}"
    if top not in _made:
        _made.add(top)
        atexit.register(drop_path, spark, top)
    return f"{top}/{name}-{uuid.uuid4().hex[:12]}"


def drop_path(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # the session has ended; the folder's owner clears it
        return


def staged(df: DataFrame, name: str, spread: bool = False) -> DataFrame:
    """df written once to the shared folder and read back: cuts lineage and survives lost executors.

    The shuffle files of the write go as it ends. ``spread`` keeps small partitions apart, for a step whose
    work is far more than its bytes. Both are set for this write only.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    own = {CLEANUP: "true"} | ({COALESCE: "false"} if spread else {})
    was = {k: spark.conf.get(k, None) for k in own}
    for k, v in own.items():
        spark.conf.set(k, v)
    try:
        df.write.parquet(path)
    finally:
        for k, v in was.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    made = spark.read.schema(df.schema).parquet(path)
    made._staged_path = path
    return made


def drop_staged(*tables: DataFrame) -> None:
    """Deletes the files of tables that :func:`staged` made and nothing reads any more."""
    for t in tables:
        drop_path(t.sparkSession, t._staged_path)
