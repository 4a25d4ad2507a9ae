"""What several operators share: whole groups from sorted streams, split hot groups, linked components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pithy.session import small_batches as small_batches  # the operators take it from here
from pithy.session import table_folder, table_name, written


def free_name(df: DataFrame, name: str) -> str:
    """`name`, with underscores added until no column of `df` has it, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def written_by(df: DataFrame, column: str, buckets: int) -> DataFrame:
    """Write a table bucketed by a column to the shared folder; joins on that column then do not shuffle it."""
    name = table_name(df.sparkSession)
    path = f"{table_folder(df.sparkSession)}/{name}"
    df.write.bucketBy(buckets, column).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def key_changes(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Row numbers at which a run of equal keys begins, 0 excluded."""
    changed = np.zeros(max(table.num_rows - 1, 0), dtype=bool)
    for key in keys:
        values = table.column(key).combine_chunks().to_numpy(zero_copy_only=False)
        changed |= values[1:] != values[:-1]
    return np.flatnonzero(changed) + 1


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int = 50_000) -> Iterator[pa.Table]:
    """Tables of complete key runs from a partition sorted by `keys`.

    At most about `rows` rows and one group are held at a time.
    """
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        held.append(batch)
        count += batch.num_rows
        if count < rows:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        starts = key_changes(table, keys)
        if len(starts):
            yield table.slice(0, int(starts[-1]))
            table = table.slice(int(starts[-1]))
        held, count = table.to_batches(), table.num_rows
    if count:
        yield pa.Table.from_batches(held).combine_chunks()


def split_hot_groups(df: DataFrame, keys: list[str], salt: Column, size: int) -> DataFrame:
    """Adds `block_a`, `block_b`: the parts of its group in which a row takes part.

    Groups of at most `size` rows stay whole (0, 0). A larger group is dealt into
    blocks of about `size` rows; each row goes to every pair of blocks that holds
    its own, so any two rows of the group meet in a task of about two blocks.
    `block` is the row's own.
    """
    hot = (
        df.groupBy(*keys).count().where(F.col("count") > size)
        .select(*[F.col(k).alias(f"_{k}") for k in keys], F.ceil(F.col("count") / size).cast("int").alias("_blocks"))
    )
    same = F.lit(True)
    for k in keys:
        same = same & (F.col(k) == F.col(f"_{k}"))
    own = F.pmod(salt, F.col("_blocks")).cast("int")
    others = F.when(F.col("_blocks").isNull(), F.array(F.lit(0))).otherwise(
        F.sequence(F.lit(0), F.coalesce(F.col("_blocks"), F.lit(1)) - 1)
    )
    dealt = (
        df.join(hot, same, "left")
        .withColumn("block", F.coalesce(own, F.lit(0)))
        .withColumn("_other", F.explode(others))
        .withColumn("block_a", F.least("block", "_other"))
        .withColumn("block_b", F.greatest("block", "_other"))
    )
    return dealt.drop(*[f"_{k}" for k in keys], "_blocks", "_other")


def deal_blocks(df: DataFrame, salt: Column, blocks: str = "blocks") -> DataFrame:
    """Adds `block`, `block_a`, `block_b` to rows whose column `blocks` says into how many blocks their group is dealt (null: one)."""
    many = F.coalesce(F.col(blocks), F.lit(1))
    return (
        df.withColumn("block", F.pmod(salt, many).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), many - 1)))
        .withColumn("block_a", F.least("block", "_other"))
        .withColumn("block_b", F.greatest("block", "_other"))
    ).drop(blocks, "_other")


def join_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Merge the classes of the linked rows a and b; every label is its class's least row number."""
    while True:
        low = np.minimum(labels[a], labels[b])
        before = labels
        labels = labels.copy()
        np.minimum.at(labels, before[a], low)
        np.minimum.at(labels, before[b], low)
        while True:
            jumped = labels[labels]
            if np.array_equal(jumped, labels):
                break
            labels = jumped
        if np.array_equal(labels[a], labels[b]):
            return labels


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every linked node; root is the least node of its component.

    Alternates the large-star and small-star steps until no edge moves; each
    round is written to the shared folder. Minima are combined before the
    shuffle, and the joins are plain ones whose hot side Spark may split.
    """
    e = written(
        edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(),
        "edges",
    )
    seen = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.explode(F.array(
                F.struct("u", F.col("m").alias("v")),
                F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            )).alias("s")
        ).select("s.u", "s.v").where("u != v").distinct()
        e = written(small, "edges")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = now
