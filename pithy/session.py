"""Session settings the jobs rely on."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g", partitions: int | None = None,
    config: dict[str, str] | None = None,
) -> SparkSession:
    """A session for tests and single-machine runs; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config(map=config or {})
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if partitions:
        spark.conf.set("pithy.partitions", partitions)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables and stream progress.

    The cluster names it in `spark.checkpoint.dir`; where that is unset, the
    warehouse folder serves, which executors share as well. Never a temp folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    return root or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/pithy-checkpoint"


JOB = "pithy.job"
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def table_folder(spark: SparkSession) -> str:
    """Where intermediate tables go: the running job's folder under `checkpoint_root`, or that itself outside any job."""
    job = spark.conf.get(JOB, None)
    return f"{checkpoint_root(spark)}/{job}" if job else checkpoint_root(spark)


def table_name(spark: SparkSession) -> str:
    """A new name for an intermediate table of the catalog, which begins with the running job's."""
    return f"{spark.conf.get(JOB, None) or 'pithy'}_{uuid.uuid4().hex}"


@contextmanager
def job(spark: SparkSession) -> Iterator[None]:
    """A block whose intermediate tables go to a folder of their own, which is removed at its end, failed or not.

    For jobs that write their results inside the block: a result not yet written still
    reads the tables. A block inside another is part of it. The Arrow batch size, which
    operators on whole texts lower, is set back as well. A driver that is killed leaves its folder.
    The job belongs to the session: jobs that run at the same time need sessions of their own (`spark.newSession()`).
    """
    if spark.conf.get(JOB, None):
        yield
        return
    name = f"pithy_job_{uuid.uuid4().hex}"
    batches = {key: spark.conf.get(key) for key in (BATCH_ROWS, BATCH_BYTES)}
    spark.conf.set(JOB, name)
    folder = table_folder(spark)
    try:
        yield
    finally:
        spark.conf.unset(JOB)
        for key, value in batches.items():
            spark.conf.set(key, value)
        for table in spark.catalog.listTables(pattern=f"{name}_*"):
            spark.sql(f"DROP TABLE IF EXISTS `{table.name}`")
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def small_batches(spark: SparkSession, rows: int = 1000, size: int = 8 << 20) -> None:
    """Sends whole texts to Python in batches of at most `rows` and about `size` bytes, unless the session already has smaller ones.

    Spark's 10,000 rows and 64 MB suit short rows; of texts they fill tens of megabytes on both sides, times the
    workers of an executor. A longer text is a batch alone. The settings stay, since results run later; the
    end of a `session.job` sets them back.
    """
    if int(spark.conf.get(BATCH_ROWS)) > rows:
        spark.conf.set(BATCH_ROWS, rows)
    if not 0 < _bytes(spark.conf.get(BATCH_BYTES)) <= size:
        spark.conf.set(BATCH_BYTES, size)


def _bytes(value: str) -> int:
    """Bytes of a setting such as 67108864b, 64m or 64mb."""
    number = value.strip().lower().removesuffix("b")
    power = "kmgtp".find(number[-1:]) + 1 if number[-1:].isalpha() else 0
    return int(number[: -1 if power else None]) << 10 * power


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """Write a table to the shared folder and read it back.

    Cuts the lineage, survives lost executors, and gives the optimizer the
    table's true size for its choice of joins.
    """
    path = f"{table_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Deal an input over as many partitions as the session's `pithy.partitions` names.

    For small inputs of one row group, which are one task however many cores are
    idle. Where the setting is absent the scan's own partitions stay, unshuffled.
    """
    partitions = df.sparkSession.conf.get("pithy.partitions", None)
    return df.repartition(int(partitions)) if partitions else df
