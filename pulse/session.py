"""Session settings every job relies on, and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# UTC so that epoch arithmetic and calendar weeks agree on every host; AQE so
# that joins are re-planned (broadcast, skew split, coalesce) on measured sizes.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(app: str = "pulse", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables: one of the application in the cluster's shared checkpoint
    folder, so that all of it can be removed when the application has ended.

    Only on a local master, where driver and executors are one process, may the setting be
    missing; the folder is then a temporary one that goes when the process ends.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="pulse-checkpoint-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
    if not context.getCheckpointDir():
        context.setCheckpointDir(configured)
    return f"{configured}/pulse-{context.applicationId}"


_open_scopes: list[list[str]] = []


def cut(df: DataFrame) -> DataFrame:
    """Write a frame several plans read to the shared folder and read it back.

    The table outlives executors, keeps column pruning and filter pushdown, and
    its real size is known to the plans that use it.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{uuid.uuid4().hex}"
    if _open_scopes:
        _open_scopes[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_result(make: Callable[[], DataFrame]) -> DataFrame:
    """The frame that ``make`` returns, written; the tables that were cut to make it are removed then."""
    _open_scopes.append([])
    try:
        made = make()
        result = cut(made)
    finally:
        paths = _open_scopes.pop()
    *intermediate, last = paths
    _remove(made.sparkSession, intermediate)
    if _open_scopes:
        _open_scopes[-1].append(last)
    return result


def _remove(spark: SparkSession, paths: Iterable[str]) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    for path in paths:
        folder = hadoop(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def cut_counted(df: DataFrame, **counts: Column) -> tuple[DataFrame, dict]:
    """The same, with aggregates that are counted while the table is written."""
    observed = Observation()
    stored = cut(df.observe(observed, *[c.alias(name) for name, c in counts.items()]))
    return stored, observed.get


def literal_rows(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    """A table written in the code. Built from literals rather than a Python
    RDD, so Catalyst knows how small it is."""
    fields = T.StructType.fromDDL(schema).fields
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, fields, strict=True)])
        for row in rows
    ]
    if not structs:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*structs)))
