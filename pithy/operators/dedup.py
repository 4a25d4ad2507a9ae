"""Drop repeated articles."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pithy.functions import patterns as P
from pithy.functions import text
from pithy.session import written


def deduplicate(df: DataFrame, article_col: str = "article", id_col: str = "id") -> DataFrame:
    """Keep the row with the lowest id of every article, ignoring case and outer space.

    Blank articles are dropped; a null id is the lowest. Digests and ids alone are
    shuffled, and counted before, to find the rows that go; their table is written,
    so that Spark knows whether it can be broadcast and the texts stay in place.
    """
    key = F.lower(text.strip(F.coalesce(F.col(article_col), F.lit(""))))
    digest = F.unhex(F.sha2(key, 256))
    # As a search for one visible character, so that a blank text is told without stripping a copy of it.
    rows = df.where(F.col(article_col).rlike(f"[^{P.WS_RANGES}]"))
    slim = rows.select(digest.alias("_digest"), F.col(id_col).alias("_id")).groupBy("_digest", "_id").agg(F.count("*").alias("_n"))
    repeated = slim.groupBy("_digest").agg(
        F.sum("_n").alias("_all"), F.min("_id").alias("_least"), F.bool_or(F.col("_id").isNull()).alias("_null")
    ).where("_all > 1")
    lowest = F.when(F.col("_null"), F.col("_id").isNull()).otherwise(F.col("_id").eqNullSafe(F.col("_least")))
    # Rows that go, and those of which several share the lowest id.
    marked = written(slim.join(repeated, "_digest").withColumn("_first", lowest).where("not _first or _n > 1").select(
        F.col("_digest").alias("_d"), "_id", "_first"
    ), "repeated-articles")
    # Joined by id; as a range, the digest is no key and is taken only of the rows whose id is marked.
    same = F.col(id_col).eqNullSafe(F.col("_id")) & (digest >= F.col("_d")) & (digest <= F.col("_d"))
    once = rows.join(marked, same, "left_anti").select(*df.columns)
    shared = marked.where("_first")
    if shared.isEmpty():
        return once
    order = Window.partitionBy("_digest").orderBy(F.col(id_col), *[F.col(c) for c in df.columns if c != id_col])
    again = rows.withColumn("_digest", digest).join(shared, same, "left_semi").withColumn("_rank", F.row_number().over(order))
    return once.unionByName(again.where("_rank = 1").select(*df.columns))
