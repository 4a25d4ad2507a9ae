"""Reading article-summary tables and plain articles."""

from __future__ import annotations

from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from pithy.operators.quality import CORRUPT, DataValidationError
from pithy.session import written
from pithy.sources.records import read_delimited

PAIR_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("article", T.StringType()),
    T.StructField("highlights", T.StringType()),
    T.StructField("split", T.StringType()),
])

# File suffixes and the formats they stand for.
FORMATS = {".csv": "csv", ".tsv": "tsv", ".parquet": "parquet", ".jsonl": "jsonl"}

# What the usual CSV readers take for a missing value.
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
    "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def read_pairs(
    spark: SparkSession, path: str, fmt: str | None = None, schema: T.StructType | None = None,
    label_corrupt: bool = False, whole_files: bool = False,
) -> DataFrame:
    """Read a table by suffix or explicit format: csv, tsv, parquet or jsonl.

    `path` may name a file, a folder or a glob. Without a schema CSV takes the
    header's columns and JSON every key that occurs, all as text. With `label_corrupt` a line that does not
    parse, or a CSV line of another number of fields than the header, is kept in
    `_corrupt_record`; the checks of `quality` then reject it.

    CSV files are read in many tasks, line breaks in quotes included; `whole_files` reads each in
    one, by Spark's own multi-line reader.
    """
    fmt = fmt or FORMATS.get(PurePosixPath(path).suffix.lower())
    if fmt not in FORMATS.values():
        raise DataValidationError(f"Cannot tell the format of {path}: name csv, tsv, parquet or jsonl")
    bad = {"columnNameOfCorruptRecord": CORRUPT} if label_corrupt else {}
    try:
        if fmt == "parquet":
            return (spark.read.schema(schema) if schema else spark.read).parquet(path)
        if fmt == "jsonl":
            if not schema:
                return read_json_lines(spark, path, label_corrupt)
            fields = [f for f in schema if f.name != CORRUPT]
            if label_corrupt:
                fields.append(T.StructField(CORRUPT, T.StringType()))
            return spark.read.options(primitivesAsString=True, **bad).schema(T.StructType(fields)).json(path)
        # Quoted line breaks and doubled quotes are part of the text.
        reader = spark.read.options(
            header=True, multiLine=True, quote='"', escape='"', sep="\t" if fmt == "tsv" else ",",
            enforceSchema=False, **bad,
        )
        fields = schema or reader.csv(path).schema  # reads headers only
        if label_corrupt:
            fields = T.StructType([*fields, T.StructField(CORRUPT, T.StringType())])
        if whole_files:
            df = reader.schema(fields).csv(path)
        else:
            df = read_delimited(spark, path, fields, "\t" if fmt == "tsv" else ",", CORRUPT if label_corrupt else None)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise DataValidationError(f"There is nothing at {path}") from error
        raise
    return df.withColumns({
        f.name: F.when(~F.col(f.name).isin(*MISSING), F.col(f.name))
        for f in df.schema if f.dataType == T.StringType() and f.name != CORRUPT
    })


def read_json_lines(spark: SparkSession, path: str, label_corrupt: bool = False) -> DataFrame:
    """JSON lines with every key that occurs, in alphabetic order, as text; nested values as JSON.

    The texts are read and parsed once, into a written table of maps. The keys come from that table, whose
    values are not read for it; the driver gets each key once. Of a key that a line repeats the first counts. Blank
    lines are no rows; a line that is no object gives nulls, and itself under `_corrupt_record`.
    """
    lines = spark.read.text(path).where(F.trim("value") != "")
    entries = F.from_json("value", "map<string,string>")
    parsed = written(lines.select(entries.alias("entries"), F.when(entries.isNull(), F.col("value")).alias("bad")), "json-lines")
    keys = sorted(r[0] for r in parsed.select(F.explode(F.map_keys("entries"))).distinct().collect())
    if label_corrupt and CORRUPT in keys:
        keys.remove(CORRUPT)
    values = [F.try_element_at("entries", F.lit(key)).alias(key) for key in keys]
    return parsed.select(*values, *([F.col("bad").alias(CORRUPT)] if label_corrupt else []))


def read_articles(spark: SparkSession, path: str) -> DataFrame:
    """Every text file of a folder as one article: (path, article)."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("article")
    )


def limit_rows(df: DataFrame, max_rows: int | None) -> DataFrame:
    """Any `max_rows` rows, or all if there are fewer; None or a value below 1 means all of them.

    Every task keeps at most that many of its first rows. These are written, and
    the counts per task, one number each, say how many of which stay:
    nothing is gathered in one partition, and a second reading gives the same rows.
    """
    if not max_rows or max_rows <= 0:
        return df
    place = "_place"
    while place in df.columns:
        place += "_"
    within = (1 << 33) - 1  # Spark numbers the rows of a task from its number times 2^33
    numbered = df.withColumn(place, F.monotonically_increasing_id())
    kept = written(numbered.where(F.col(place).bitwiseAND(within) < max_rows), "limited")
    counts = written(kept.groupBy(F.shiftright(place, 33).alias("task")).count(), "task-counts")
    if counts.agg(F.sum("count")).first()[0] is None:
        return kept.drop(place)
    # Coarse sums first, so that no window runs over more than a thousand tasks or groups of them.
    group = F.shiftright("task", 10)
    groups = counts.groupBy(group.alias("g")).agg(F.sum("count").alias("n"))
    before_group = groups.withColumn("before", F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("g")) - F.col("n")).select("g", "before")
    within_group = F.sum("count").over(Window.partitionBy("g").orderBy("task")) - F.col("count")
    quota = (
        counts.withColumn("g", group).withColumn("earlier", within_group).join(before_group, "g")
        .select("task", (F.lit(max_rows) - F.col("before") - F.col("earlier")).alias("quota")).where("quota > 0")
    )
    quota = written(quota, "quotas")  # one row per task
    own = F.shiftright(F.col(place), 33) == F.col("task")
    return kept.join(F.broadcast(quota), own).where(F.col(place).bitwiseAND(within) < F.col("quota")).select(*df.columns)
