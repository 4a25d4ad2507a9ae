"""Bring corpora with their own column names under one schema."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


ROW_KEY = "row_key"


@dataclass(frozen=True)
class CorpusSpec:
    """Where a corpus keeps its texts; `id` may be absent from the table."""

    source: str
    article: str
    summary: str
    id: str = "id"


# The two public corpora and their text columns.
SPECS = {
    "cnn_dailymail": CorpusSpec("cnn_dailymail", "article", "highlights"),
    "xsum": CorpusSpec("xsum", "document", "summary"),
}


def read_with_row_keys(spark: SparkSession, path: str) -> DataFrame:
    """Parquet files with `row_key`: a digest of the file's name and the row's number in it.

    A row keeps its key however the files are split or dealt out, and identical rows
    have different ones. Names count below `path`, so a copied folder keeps its keys.
    """
    df = spark.read.parquet(path)
    root = path.split("*")[0].rstrip("/").rsplit("/", 1)[-1]
    name = F.regexp_extract(F.col("_metadata.file_path"), f"{re.escape(root)}[^/]*(?:/(.*))?$", 1)
    return df.withColumn(ROW_KEY, F.md5(F.concat_ws("\x01", name, F.col("_metadata.row_index").cast("string"))))


def harmonise(df: DataFrame, spec: CorpusSpec, split: str = "test") -> DataFrame:
    """Select (id, source, article, highlights, split); missing text becomes ''.

    Rows without an id get one of their own: `row_key` if the table has that column (see
    `read_with_row_keys`), else a digest of their text, which identical rows share. Neither depends on
    partitions or on the order in which files are read.
    """
    def of(name: str) -> Column:
        return F.col(name).cast("string") if name in df.columns else F.lit(None).cast("string")

    article, summary = (F.coalesce(of(c), F.lit("")) for c in (spec.article, spec.summary))
    if ROW_KEY in df.columns:
        surrogate = F.concat_ws("-", F.lit(spec.source), F.col(ROW_KEY))
    else:
        surrogate = F.md5(F.concat_ws("\x01", F.lit(spec.source), article, summary))
    return df.select(
        F.coalesce(of(spec.id), surrogate).alias("id"),
        F.lit(spec.source).alias("source"),
        article.alias("article"), summary.alias("highlights"), F.lit(split).alias("split"),
    )


def union_corpora(*corpora: DataFrame) -> DataFrame:
    """All rows of several harmonised corpora."""
    return reduce(lambda a, b: a.unionByName(b), corpora)
