"""Operators inside a job leave no intermediate tables, and the same results."""

from pathlib import Path

from pithy.llm.passages import remove_repeats, repeat_digests
from pithy.session import BATCH_ROWS, checkpoint_root, job


def test_bucketed_tables_of_a_job_go_with_it(spark, tmp_path):
    docs = spark.createDataFrame([(i, ("shared passage of more than fifty bytes, repeated in every text " * 2) + str(i)) for i in range(12)], "doc_id long, text string")
    want = sorted(repeat_digests(remove_repeats(docs)).collect())
    root = Path(checkpoint_root(spark).removeprefix("file:"))
    before, tables, rows = sorted(root.iterdir()), spark.catalog.listTables(), spark.conf.get(BATCH_ROWS)
    with job(spark):
        repeat_digests(remove_repeats(docs)).write.parquet(str(tmp_path / "out"))
    assert sorted(spark.read.parquet(str(tmp_path / "out")).collect()) == want
    assert sorted(root.iterdir()) == before and spark.catalog.listTables() == tables and spark.conf.get(BATCH_ROWS) == rows
