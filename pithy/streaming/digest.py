"""Digest of web pages as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pithy.operators.pages import parse_pages
from pithy.operators.summarize import Method, summarize
from pithy.session import checkpoint_root

PAGE_SCHEMA = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
])


def digest_pages(pages: DataFrame, method: str | Method = "lead_3", n: int = 3) -> DataFrame:
    """Parse pages and summarise them; the same on batches and streams.

    Every page stays: one too short to be an article keeps its `status` and has an
    empty summary. Every step is row-local, so a stream needs no state and no watermark.
    """
    parsed = parse_pages(pages).withColumn("_long", F.when(F.col("status") == "ok", F.col("article")))
    return summarize(parsed, method, n, "_long").drop("_long")


def start_page_digest(
    spark: SparkSession, in_dir: str, out_dir: str, name: str = "page_digest",
    method: str | Method = "lead_3", n: int = 3, max_files_per_trigger: int = 1000,
    checkpoint_dir: str | None = None,
) -> StreamingQuery:
    """Digest the page files that are new in a folder, then stop.

    Progress is kept in `checkpoint_dir`, by default under the cluster's checkpoint
    folder: a rerun takes up only files not yet digested, and a lost executor or
    restart repeats no output.
    """
    pages = (
        spark.readStream.schema(PAGE_SCHEMA)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .parquet(in_dir)
    )
    return (
        digest_pages(pages, method, n)
        .writeStream.format("parquet").outputMode("append")
        .option("path", out_dir)
        .option("checkpointLocation", checkpoint_dir or f"{checkpoint_root(spark)}/{name}")
        .trigger(availableNow=True)
        .queryName(name)
        .start()
    )
