"""Delimited files whose quoted fields hold line breaks, read in many tasks.

A file's splits are read as lines. What a line does to the state "inside a quoted
field" is a function of that state, so a split's lines compose to one such function;
the splits of a file, in order, then tell each where its first record begins.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pithy.session import written

# Executors need not have this package installed: ship the code with the plan.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SPLIT = ("file", "start")
#: Splits (of 128 MB, as a rule) of which one row each may be broadcast; beyond that lines are sorted by split.
BROADCAST_SPLITS = 200_000


def line_states(line: Column, sep: str) -> tuple[Column, Column]:
    """Whether a line ends inside a quoted field, if it begins outside of one and if it begins inside.

    A quote opens a field only as its first character; a doubled quote is one of the text.
    """
    s = "\\t" if sep == "\t" else sep
    body = r'[^"]*+(?:""[^"]*+)*+'  # of a quoted field, up to the quote that ends it
    field = rf'(?:"{body}"[^{s}]*+|[^"{s}][^{s}]*+)?+'
    rest = rf'(?:{field}{s})*+"{body}$'  # whole fields, then one that does not end
    outside = line.contains('"') & line.rlike(f"(?s)^{rest}")
    inside = ~line.contains('"') | line.rlike(rf'(?s)^{body}$') | line.rlike(rf'(?s)^{body}"[^{s}]*+{s}{rest}')
    return outside, inside


def split_lines(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """(file, start, line, outside, inside) of every line, in the file's order within a split."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("line")
    )
    outside, inside = line_states(F.col("line"), sep)
    return lines.select(*SPLIT, "line", outside.alias("outside"), inside.alias("inside"))


def runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """The batch cut where the file or the split changes."""
    begin = 0
    files, starts = batch.column("file"), batch.column("start")
    for at in range(1, batch.num_rows + 1):
        if at == batch.num_rows or starts[at] != starts[begin] or files[at] != files[begin]:
            yield (files[begin].as_py(), starts[begin].as_py()), batch.slice(begin, at - begin)
            begin = at


def split_states(lines: DataFrame) -> DataFrame:
    """(file, start, outside, inside, breaks_outside, breaks_inside): a split's lines as one function.

    breaks: whether some line ends outside of a quoted field, so that a record ends in the split.
    """

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int], list[bool]] = {}
        for batch in batches:
            for key, run in runs(batch):
                now = held.setdefault(key, [False, True, False, False])
                for outside, inside in zip(run.column("outside").to_pylist(), run.column("inside").to_pylist()):
                    now[0], now[1] = (inside if now[0] else outside), (inside if now[1] else outside)
                    now[2], now[3] = now[2] or not now[0], now[3] or not now[1]
        rows = [(*key, *state) for key, state in held.items()]
        types = [pa.string(), pa.int64(), *[pa.bool_()] * 4]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 6, types)], names)

    names = [*SPLIT, "outside", "inside", "breaks_outside", "breaks_inside"]
    schema = "file string, start long, outside boolean, inside boolean, breaks_outside boolean, breaks_inside boolean"
    return lines.select(*SPLIT, "outside", "inside").mapInArrow(compose, schema)


def split_starts(states: DataFrame) -> DataFrame:
    """(file, start, open, owner): whether a split begins inside a quoted field, and the split in which that record began.

    Runs over one row per split. The state after a split is that of its own function if
    the function does not depend on its start; else it follows from the last split whose does not
    and the number of splits since that turn the state around.
    """
    order = Window.partitionBy("file").orderBy("start")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    turns = F.col("outside") & ~F.col("inside")
    fixed = F.when(F.col("outside") == F.col("inside"), F.col("outside"))
    numbered = states.withColumn("turns", F.sum(turns.cast("long")).over(order))
    numbered = numbered.withColumn("set", F.when(fixed.isNotNull(), F.struct(fixed.alias("to"), F.col("turns").alias("at"))))
    last = F.last("set", ignorenulls=True).over(before)
    so_far = F.coalesce(F.lag("turns").over(order), F.lit(0))
    begun = numbered.withColumn("_last", last).withColumn(
        "open", (F.coalesce(F.col("_last.to"), F.lit(False)).cast("int") + so_far - F.coalesce(F.col("_last.at"), F.lit(0))) % 2 == 1
    )
    # The record at a split's end began there if a record ended in it, or if the split began outside.
    ends_open = F.when(F.col("open"), F.col("inside")).otherwise(F.col("outside"))
    breaks = F.when(F.col("open"), F.col("breaks_inside")).otherwise(F.lit(True))
    return begun.withColumn("owner", F.last(F.when(ends_open & breaks, F.col("start")), ignorenulls=True).over(before)).select(*SPLIT, "open", "owner")


def pieces(lines: DataFrame) -> DataFrame:
    """(file, start, no, record, part_of): whole records, and parts of records that cross splits.

    lines: in order within a split, with `open` and `owner`. part_of names the split
    in which the record of a part began; no counts a split's records.
    """
    names = [*SPLIT, "no", "record", "part_of"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64()]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, no, held, open_, head, owner, out = None, 0, [], False, False, None, []

        def flush(ends: bool) -> None:
            text = "\n".join(held)
            whole = ends and not head
            if whole and text in ("", "\r"):
                return
            if whole and text.endswith("\r"):  # a file of such line ends: they are plain ones inside of quotes too
                text = text[:-1].replace("\r\n", "\n")
            out.append((*key, no, text, None if whole else owner if head else key[1]))

        for batch in batches:
            for now, run in runs(batch):
                if now != key:
                    if held:
                        flush(False)
                    key, no, held = now, 0, []
                    open_ = head = run.column("open")[0].as_py()
                    owner = run.column("owner")[0].as_py()
                for line, outside, inside in zip(*[run.column(c).to_pylist() for c in ("line", "outside", "inside")]):
                    held.append(line)
                    open_ = inside if open_ else outside
                    if not open_:
                        before = len(out)
                        flush(True)
                        no += len(out) - before
                        held, head = [], False
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 5, types)], names)
            out = []
        if held:
            flush(False)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 5, types)], names)

    return lines.mapInArrow(join, "file string, start long, no long, record string, part_of long")


def read_records(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """(first, record): every record of the files as text, its line breaks included; blank lines are none.

    `first` marks a file's first record. Records stay where their split is read; only
    the parts of those that cross splits are shuffled, about two per split. A quote that is
    never closed makes the rest of its file one record.
    """
    lines = split_lines(spark, path, sep)
    starts = written(split_starts(split_states(lines)), "split-starts")
    if starts.count() <= BROADCAST_SPLITS:
        keyed = lines.join(F.broadcast(starts), list(SPLIT))
    else:
        numbered = lines.withColumn("at", F.monotonically_increasing_id())
        keyed = numbered.join(starts, list(SPLIT)).repartition(*SPLIT).sortWithinPartitions(*SPLIT, "at").drop("at")
    found = pieces(keyed)
    first = (F.col("start") == 0) & (F.col("no") == 0)
    whole = found.where("part_of is null").select(first.alias("first"), "record")
    parts = found.where("part_of is not null").groupBy("file", "part_of").agg(
        F.array_sort(F.collect_list(F.struct("start", "no", "record"))).alias("p"))
    joined = F.array_join(F.transform("p", lambda x: x["record"]), "\n")
    joined = F.when(F.endswith(joined, F.lit("\r")), F.regexp_replace(F.replace(joined, F.lit("\r\n"), F.lit("\n")), "\r\\z", "")).otherwise(joined)
    opening = F.col("p")[0]
    return whole.unionByName(parts.select(
        ((opening["start"] == 0) & (opening["no"] == 0) & (F.col("part_of") == 0)).alias("first"), joined.alias("record")))


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, sep: str, corrupt: str | None = None) -> DataFrame:
    """The rows of delimited files with a header; `schema` may end in the column of lines that do not fit.

    Fails if a file's header names other columns than the schema.
    """
    options = {"sep": sep, "quote": '"', "escape": '"', "multiLine": "true", "mode": "PERMISSIVE"}
    if corrupt:
        options["columnNameOfCorruptRecord"] = corrupt
    names = [f.name for f in schema if f.name != corrupt]
    fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema)
    header = ", ".join(f"c{i} string" for i in range(len(names)))
    records = read_records(spark, path, sep)
    own = F.from_csv(F.regexp_replace("record", "^\ufeff", ""), F.lit(header), options)
    fits = F.lit(True)
    for i, name in enumerate(names):
        fits = fits & (F.lower(F.trim(own[f"c{i}"])).eqNullSafe(F.lit(name.lower())) | own[f"c{i}"].isNull() | F.lit(name.startswith("_c")))
    refused = F.raise_error(F.concat(F.lit(f"A header does not name {', '.join(names)}: "), F.col("record"))).cast("boolean")
    rows = records.where(F.when(F.col("first"), F.when(fits, F.lit(False)).otherwise(refused)).otherwise(F.lit(True)))
    return rows.select(F.from_csv("record", F.lit(fields), options).alias("r")).select("r.*")
