"""Validate, split, summarise, score and report a corpus in one job.

    spark-submit --py-files pithy.zip run_all.py IN_PATH OUT_DIR
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pithy.operators import evaluate as E
from pithy.operators import quality as Q
from pithy.operators import reports as R
from pithy.operators.split import cap_rows, split_dataset
from pithy.operators.summarize import Method, choose_methods
from pithy.session import job, small_batches, written
from pithy.sources.readers import read_pairs
from pithy.sources.sinks import commit_run, new_run, read_rows, write_metrics, write_rows, write_summary


def run_all(
    spark: SparkSession, in_path: str, out_dir: str, methods: Sequence[str | Method] | None = None,
    n: int = 3, variants: Sequence[str] = E.ALL_VARIANTS, max_examples: int | None = None,
    seed: int = 42, fmt: str | None = None, cols: Q.Columns = Q.DEFAULT, on_bad_rows: str = "raise",
) -> dict[str, str]:
    """Write every result of a corpus under `out_dir`; return the paths by name.

    The tables go to a folder of this run, which becomes the current one when all of them are there
    (`sinks.current_run` finds it); a run that fails or is killed leaves the earlier results as they are.

    `on_bad_rows` is 'raise' (stop at the first failed check) or 'quarantine'
    (set bad rows aside and go on). All test rows are scored unless the caller names
    `max_examples`. The seconds of every summary are those of the scoring run itself. Intermediate
    tables are removed at the end.
    """
    with job(spark):
        small_batches(spark)  # cleaning comes before the summaries, which set it too
        raw = read_pairs(spark, in_path, fmt, label_corrupt=True)
        Q.check_columns(raw, cols)
        if not cols.id or cols.id not in raw.columns:
            cols = Q.Columns(cols.article, cols.summary, "id", cols.source)
            raw = raw.withColumn("id", F.md5(F.concat_ws("\x01", cols.article, cols.summary)))
        run = new_run(out_dir)
        paths = {name: f"{run}/{name}" for name in (
            "profile", "rejected", "prepared", "qualitative_review", "method_summary", "rouge_metrics",
        )}

        # Checked once: profile, rejected rows and good rows read the same table.
        checked = written(Q.add_checks(raw, cols), "checked")
        report = Q.profile(checked, cols) if on_bad_rows == "quarantine" else Q.validate(checked, cols)
        row = report.first()
        spark.createDataFrame([row], report.schema).write.mode("overwrite").json(paths["profile"])
        columns = [c for c in raw.columns if c != Q.CORRUPT]
        if on_bad_rows == "quarantine":
            checked.where("reject_reason is not null").write.mode("overwrite").parquet(paths["rejected"])
        good = checked.where("reject_reason is null").select(*columns)

        # Split by id before cleaning, so that the cut-off does not clean texts. Written
        # once, read by everything that follows; a reader of one part skips the others.
        prepared = Q.prepare(split_dataset(good, cols.id, seed), cols)
        prepared.write.mode("overwrite").partitionBy("split").parquet(paths["prepared"])
        prepared = spark.read.parquet(paths["prepared"])
        test = cap_rows(prepared.where(F.col("split") == "test"), max_examples, cols.id, seed)

        write_rows(E.score_methods(test, methods, n, variants, cols=cols, timed=True), paths["qualitative_review"])
        scores = read_rows(spark, paths["qualitative_review"])
        summary = E.method_summary(scores, variants)
        write_summary(summary, paths["method_summary"])
        write_metrics(summary, paths["rouge_metrics"])
        names = [m.name for m in choose_methods(methods)]
        for name, table in report_tables(prepared, scores, summary, variants, cols, names).items():
            paths[name] = f"{run}/reports/{name}"
            # Tables by source grow with the sources; the others have a fixed bound.
            table = table if name in ("quality", "sources") else table.coalesce(1)
            table.write.mode("overwrite").json(paths[name])
        commit_run(spark, run)
        return paths


def report_tables(
    prepared: DataFrame, scores: DataFrame, summary: DataFrame, variants: Sequence[str],
    cols: Q.Columns = Q.DEFAULT, methods: Sequence[str] = (),
) -> dict[str, DataFrame]:
    """The report tables by name; each is small whatever the size of the corpus."""
    tables = {
        "rouge_comparison": R.rouge_matrix(summary, variants),
        "article_length": R.length_histogram(prepared, cols.article),
        "summary_length": R.length_histogram(prepared, cols.summary),
        "compression_ratio": R.compression_by_method(summary),
        "score_distribution": R.score_distribution(scores, variants),
        "precision_recall": E.precision_recall(scores, variants),
        "describe_lengths": R.describe_lengths(prepared, cols),
        "split_skew": R.split_skew(prepared, cols),
    }
    if cols.source and cols.source in prepared.columns:
        tables["sources"] = Q.distinct_sources(prepared, cols)
    if "rouge1" in variants:
        for left, right in combinations(methods, 2):
            tables[f"paired_{left}_{right}"] = R.paired_comparison(scores, left, right, id_col=cols.id)
        by = [cols.source] if cols.source and cols.source in scores.columns else []
        tables["per_example_rouge"] = R.score_curve(scores)
        tables["best_and_worst"] = R.best_and_worst(scores, id_col=cols.id)
        tables["quality"] = R.quality_by_characteristic(scores, by)
    return tables


if __name__ == "__main__":
    run_all(SparkSession.builder.getOrCreate(), sys.argv[1], sys.argv[2])
