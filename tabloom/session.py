"""Session helpers: a tuned local session for tests, and lineage cuts on shared storage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def local_session(name: str = "tabloom", cores: int | str = "*", partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the benchmark; clusters bring their own session."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Point reliable checkpoints at the folder the cluster names.

    The folder comes from ``spark.checkpoint.dir``. Only a local master, where driver and
    executors share one disk, may fall back to a temporary folder.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if folder is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="tabloom-checkpoint-")
    sc.setCheckpointDir(folder)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the reliable checkpoint folder and continue from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def keep(df: DataFrame) -> DataFrame:
    """Cache an input that several jobs scan; a lost block is recomputed from its lineage."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder next to the checkpoints, for tables that are written and read back."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir().rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again; the planner then knows its size."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


ARROW_KINDS = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64()}


def driver_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A table made on the driver. Spark reads a list of rows by Python processes on every executor, an Arrow table by itself."""
    fields = [field.split() for field in schema.split(", ")]
    columns = {name: pa.array([r[i] for r in rows], ARROW_KINDS[kind]) for i, (name, kind) in enumerate(fields)}
    return spark.createDataFrame(pa.table(columns), schema)


VALUES_PER_PARTITION = 500_000


TASKS_PER_CORE = 4


def dealt(df: DataFrame, rows: int, width: int, partitions: int | None = None, work: int = 0) -> DataFrame:
    """Deal the input of an iterative fit out evenly.

    Every step of such a fit is a job over all rows, so they should sit neither in hundreds of tiny
    partitions nor in the one that a single-file scan gave. The partitions hold about
    ``VALUES_PER_PARTITION`` numbers each unless their number is given. Rows are dealt in turn, so equal
    rows spread; Spark sorts a partition before dealing it, so a repeated task deals alike. Where a step does
    more ``work`` on a row, as much as on so many numbers, there are more partitions, up to ``TASKS_PER_CORE`` for that.
    """
    if partitions is None:
        partitions = -(-rows * max(width, 1) // VALUES_PER_PARTITION)
        cores = df.sparkSession.sparkContext.defaultParallelism
        partitions = max(partitions, min(-(-rows * work // VALUES_PER_PARTITION), TASKS_PER_CORE * cores), 1)
    return df.repartition(partitions)
