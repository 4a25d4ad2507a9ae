"""Train / test / validation splits and the row cap, deterministic at any scale."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pithy.functions import text

# Hex digits of the hash that name a bucket: 65,536 of them, whatever the row count.
PREFIX = 4


def split_hash(df: DataFrame, id_col: str, seed: int) -> Column:
    """Uniform, engine-independent order of the rows: md5 of id and seed.

    A row without an id goes by a digest of its other columns, so that equal rows
    stay together and the others spread. Whether there are such rows is looked up first,
    in the id column alone, so that otherwise no other column is read.
    """
    key = F.col(id_col).cast("string")
    others = [F.col(c) for c in df.columns if c not in (id_col, "split")]
    if df.schema[id_col].nullable and not df.select(id_col).where(F.col(id_col).isNull()).isEmpty():
        content = F.sha2(F.to_json(F.struct(*others)), 256) if others else F.lit("")
        key = F.when(F.col(id_col).isNull(), F.concat(F.lit("\x00"), content)).otherwise(key)
    return F.md5(F.concat_ws(":", key, F.lit(str(seed))))


def _cut_off(hashes: DataFrame, want: Column, at_most: bool) -> DataFrame:
    """One row: the greatest hash of the first part; no row if `want` is beyond all rows.

    Rows of one hash are one weighted row from the first aggregate on. Counts per
    hash prefix find the bucket the cut falls in; only that bucket (1/65,536 of the
    keys) is then ordered. The cut comes as near to `want` rows as whole keys allow,
    or, if `at_most`, as near from below. With two keys or more neither part is empty.
    """
    prefix = F.substring("h", 1, PREFIX)
    keys = hashes.groupBy("h").agg(F.count("*").alias("n"))
    counts = keys.groupBy(prefix.alias("p")).agg(F.sum("n").alias("n"), F.count("*").alias("k"))
    # At most 16**PREFIX rows: the single-partition windows have a fixed bound.
    upto = Window.orderBy("p").rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.partitionBy()
    bucket = (
        counts.withColumns({
            "upto": F.sum("n").over(upto), "total": F.sum("n").over(everything), "keys": F.sum("k").over(everything),
        })
        .withColumn("want", want)
        .where("upto >= want and upto - n < want")
        .select("p", (F.col("upto") - F.col("n")).alias("before"), "want", "total", "keys")
    )
    in_bucket = keys.join(F.broadcast(bucket), prefix == F.col("p"))  # one row
    inside = in_bucket.select(
        "h", (F.col("before") + F.sum("n").over(Window.partitionBy("p").orderBy("h"))).alias("c"), "want", "total", "keys"
    )
    below = bucket.select(F.col("p").alias("h"), F.col("before").alias("c"), "want", "total", "keys")
    cuts = inside.unionByName(below)
    if at_most:
        return cuts.where("c <= want").agg(F.max_by("h", "c").alias("h"))
    cuts = cuts.where("(keys = 1 and c = 0) or (keys > 1 and c > 0 and c < total)")
    return cuts.agg(F.min_by("h", F.struct(F.abs(F.col("c") - F.col("want")), "c")).alias("h"))


def random_split(
    df: DataFrame, id_col: str = "id", seed: int = 42, test_size: float = 0.25,
) -> DataFrame:
    """Add `split`: ceil(test_size * n) rows are 'test', the others 'train'.

    The size is exact when ids are unique; rows that share an id, as copies may,
    stay together in one part, and the size is then the nearest possible. A table of
    a single row or key is all 'train'.
    """
    h = split_hash(df, id_col, seed)
    want = F.ceil(F.col("total") * F.lit(test_size))
    cut = _cut_off(df.select(h.alias("h")), want, at_most=False).scalar()
    return df.withColumn("split", F.when(h <= cut, "test").otherwise("train"))


def bucket_split(
    df: DataFrame, id_col: str = "id", seed: int = 42, test_size: float = 0.25,
) -> DataFrame:
    """Add `split` from the hash alone: no shuffle, test size exact only on average."""
    share = F.conv(F.substring(split_hash(df, id_col, seed), 1, 12), 16, 10).cast("double") / 16.0**12
    return df.withColumn("split", F.when(share < test_size, "test").otherwise("train"))


def canonical_split(value: Column) -> Column:
    """train, test or validation; null for anything else."""
    name = F.lower(text.strip(value.cast("string")))
    return F.when(name.isin("train", "test"), name).when(
        name.isin("validation", "val", "dev"), "validation"
    )


def split_dataset(
    df: DataFrame, id_col: str = "id", seed: int = 42, test_size: float = 0.25,
) -> DataFrame:
    """Use the table's own `split` column if it names both train and test rows.

    Rows with other labels are then dropped. Otherwise the rows are split by hash.
    Which of the two applies is looked up first, from that column alone.
    """
    if "split" not in df.columns:
        return random_split(df, id_col, seed, test_size)
    label = canonical_split(F.col("split"))
    seen = df.agg(F.count_if(label == "train").alias("train"), F.count_if(label == "test").alias("test")).first()
    if seen.train and seen.test:
        return df.withColumn("split", label).where("split is not null")
    return random_split(df, id_col, seed, test_size)


def cap_rows(df: DataFrame, cap: int | None, id_col: str = "id", seed: int = 42) -> DataFrame:
    """The first `cap` rows in hash order; all of them if cap is None or not positive.

    A filter, so the rows stay where they are. Rows that share an id stay together:
    where the last id would pass the cap, it is left out.
    """
    if not cap or cap <= 0:
        return df
    h = split_hash(df, id_col, seed)
    cut = _cut_off(df.select(h.alias("h")), F.lit(cap), at_most=True).scalar()
    return df.where(F.coalesce(h <= cut, F.lit(True)))
