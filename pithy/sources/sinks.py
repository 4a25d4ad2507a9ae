"""Writing and re-reading evaluation results."""

from __future__ import annotations

import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pithy.operators.evaluate import rounded_summary


def write_rows(scores: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Scored rows, one file per task; csv keeps line breaks and quotes readable."""
    writer = scores.write.mode("overwrite")
    if fmt == "csv":
        writer.options(
            header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
        ).csv(path)
    else:
        writer.format(fmt).save(path)


def write_summary(summary: DataFrame, path: str) -> None:
    """Rounded method summary as CSV; one row per method, so one file."""
    rounded_summary(summary).coalesce(1).write.mode("overwrite").csv(path, header=True)


def write_metrics(summary: DataFrame, path: str) -> None:
    """Unrounded metrics per method as JSON lines, the scores under `rouge`."""
    fixed = ("method", "n_examples", "mean_summary_length", "mean_compression_ratio",
             "mean_inference_seconds")
    variants = [c for c in summary.columns if c not in fixed]
    nested = summary.select(
        "method", F.struct(*variants).alias("rouge"), *[c for c in fixed[1:] if c in summary.columns]
    )
    nested.coalesce(1).write.mode("overwrite").json(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Metrics written by `write_metrics`, scores back in columns of their own."""
    df = spark.read.json(path)
    return df.select("method", "n_examples", "rouge.*", *[c for c in df.columns if c.startswith("mean_")])


def read_rows(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Scored rows written by `write_rows`."""
    if fmt != "csv":
        return spark.read.format(fmt).load(path)
    df = spark.read.options(header=True, multiLine=True, quote='"', escape='"').csv(path)
    number = [c for c in df.columns if c.endswith(("_f1", "_precision", "_recall", "_seconds"))]
    whole = [c for c in df.columns if c.endswith("_length")]
    return df.withColumns(
        {c: F.col(c).cast("double") for c in number} | {c: F.col(c).cast("int") for c in whole}
    )


COMMIT = "committed_at long, run string"


def new_run(out_dir: str) -> str:
    """A folder of its own for a run's tables; nobody reads it before `commit_run`."""
    return f"{out_dir.rstrip('/')}/run-{uuid.uuid4().hex}"


def commit_run(spark: SparkSession, run: str) -> None:
    """Make a run's tables the current ones of their folder, all at once.

    One small file names the run; Spark's own commit makes it appear whole or not at
    all. A run that ends before leaves the tables of the one before current.
    """
    out_dir, name = run.rsplit("/", 1)
    row = spark.createDataFrame([(time.time_ns(), name)], COMMIT)
    row.coalesce(1).write.json(f"{out_dir}/commits/{name}")


def current_run(spark: SparkSession, out_dir: str) -> str | None:
    """The folder of the last committed run; None if there is none."""
    out_dir = out_dir.rstrip("/")
    try:
        commits = spark.read.schema(COMMIT).json(f"{out_dir}/commits/*")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    last = commits.agg(F.max_by("run", "committed_at")).first()[0]
    return last and f"{out_dir}/{last}"
