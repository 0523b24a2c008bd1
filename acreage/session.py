"""Session defaults, lineage cuts and size-checked broadcasts."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Most rows, and most bytes, of a relation that is hinted as a broadcast; both are measured before.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 128 << 20

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Wide exposure rows have more columns than the default limit for generated code.
    "spark.sql.codegen.maxFields": "200",
    # Recording a Python call site per column expression dominates plan building for wide outputs.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "acreage", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators were planned for."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, in local mode else a folder in the session's warehouse."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if path is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = f"{spark.conf.get('spark.sql.warehouse.dir')}/shared"
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the files.

    A lost executor cannot change or lose what was written, the plan before the
    cut runs once, and later stages read only the columns they need, with the
    true size known to the planner. The files of an application lie in one
    folder named after it, which may be deleted when the application has ended.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/cuts-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *columns: str | Column) -> DataFrame:
    """Rows dealt over several tasks a core by ``columns``, for work that is large against the bytes of its input.

    Files are split, and shuffled partitions joined, by bytes alone; a number that is given is kept.
    """
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism, *columns)


def spread_counted(df: DataFrame, rows: int, *columns: str | Column) -> DataFrame:
    """The same with so many tasks that each gets about ``rows`` rows at most; the rows are counted first.

    For rows that grow much wider or more in the task they are dealt to, whose memory would else follow the input.
    """
    tasks = max(4 * df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows))
    return df.repartition(tasks, *columns)


def broadcast_counted(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Measure a relation that should be small, and hint a broadcast only within both bounds.

    Bytes are those of the rows' JSON text, which strings, arrays and structs enter in full. Beyond a bound the
    relation comes back without a hint and is joined by a shuffle; the result is the same. Nothing is written.
    """
    text = F.octet_length(F.to_json(F.struct(*df.columns)))
    rows, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(text), F.lit(0))).first()
    return F.broadcast(df) if rows <= max_rows and size <= max_bytes else df


def broadcast_written(df: DataFrame) -> DataFrame:
    """The same of a relation that is written before, for small results of long plans.

    Each plan that reads it then holds one scan in place of all its steps. The driver keeps plans, and what their
    listeners say of them, for every job, so that its memory follows the length of plans, not the rows.
    """
    return broadcast_counted(cut_lineage(df))
