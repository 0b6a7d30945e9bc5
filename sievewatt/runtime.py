"""Shared-folder, size and row-count helpers used by the operators."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MB = 1024 * 1024

# A side is broadcast only when its estimated or measured size is below this.
BROADCAST_BYTES = 32 * MB

# An input this small fits in one task, so no key in it can be too hot for one task.
SINGLE_TASK_BYTES = 128 * MB


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may go without it; it then gets a fresh folder under the local temp
    directory. On a cluster a machine-local folder would be lost with its machine, so that raises.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="sievewatt-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


_shipped: set[str] = set()


def ship_code(spark: SparkSession, root: str, names: Sequence[str]) -> None:
    """Send the Python files of the named packages and modules under ``root`` to every worker, once per application.

    Workers do not share the driver's ``sys.path``; Spark hands the archive to late executors too.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    path = os.path.join(tempfile.mkdtemp(prefix="sievewatt-code-"), "sievewatt-code.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for name in names:
            for folder, _, found in os.walk(os.path.join(root, name)):
                for f in sorted(found):
                    if f.endswith(".py"):
                        full = os.path.join(folder, f)
                        archive.write(full, os.path.relpath(full, root))
            if os.path.isfile(os.path.join(root, f"{name}.py")):
                archive.write(os.path.join(root, f"{name}.py"), f"{name}.py")
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing has used before."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder once and read it back, cutting its lineage.

    Used for small tables that several jobs need. Survives the loss of any executor.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


def durable_together(*frames: DataFrame) -> list[DataFrame]:
    """:func:`durable` for frames that do not need each other, as jobs that run at once."""
    spark = frames[0].sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    with ThreadPoolExecutor(len(frames)) as threads:
        ends = [threads.submit(inheritable_thread_target(spark)(durable), frame) for frame in frames]
    return [end.result() for end in ends]


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's own size estimate, derived from file sizes; never runs a job."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes()))


def row_bytes(schema: T.StructType) -> int:
    """Rough width of a row, for turning a measured count into a size."""
    return 16 + sum(_type_bytes(f.dataType) for f in schema.fields)


def _type_bytes(dtype: T.DataType) -> int:
    if isinstance(dtype, T.StructType):
        return row_bytes(dtype)
    if isinstance(dtype, (T.ArrayType, T.MapType)):
        return 512
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        return 64
    return 8


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    return plan_bytes(df) <= limit


def spread(df: DataFrame, rows_per_task: int) -> DataFrame:
    """``df`` dealt over as many tasks as its rows call for, for work that is heavy for a row however few bytes it has.

    Splits follow bytes, and a small file is one split. The rows are counted first.
    """
    parts = -(-df.count() // rows_per_task)
    return df.repartition(parts) if parts > 1 else df


def counted(df: DataFrame, **metrics: Column) -> tuple[DataFrame, Observation]:
    """Attach a row count (and other aggregates) that fills in while ``df`` is being written.

    Replaces a second pass over the data just to count it.
    """
    seen = Observation()
    named = [F.count(F.lit(1)).alias("rows")] + [c.alias(n) for n, c in metrics.items()]
    return df.observe(seen, *named), seen
