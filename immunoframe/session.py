"""What the Python operators need of a session."""

from __future__ import annotations

import hashlib
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Bytes a core reads at once; tables below that for every core, in fewer files than cores, are dealt out evenly.
SPREAD_BYTES = 16 << 20

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Gives the executors this package, once for each application, so that they need no copy of their own."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    _shipped.add(app)
    top = Path(__file__).parent
    files = sorted(top.rglob("*.py"))
    name = hashlib.sha256(b"".join(p.read_bytes() for p in files)).hexdigest()[:16]
    out = Path(tempfile.mkdtemp()) / f"{top.name}-{name}.zip"
    with zipfile.ZipFile(out, "w") as z:
        for p in files:
            z.write(p, p.relative_to(top.parent))
    spark.sparkContext.addPyFile(str(out))


def spread(df: DataFrame) -> DataFrame:
    """df for a step whose work is far more than its bytes: a small table in a few files is dealt to all cores."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.isStreaming or df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() >= SPREAD_BYTES * cores:
        return df
    return df.repartition(cores) if 0 < len(df.inputFiles()) < cores else df
