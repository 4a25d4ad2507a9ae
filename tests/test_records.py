"""Delimited files in many splits against Spark's own whole-file reader."""

import random

import pytest
from pithy.operators.quality import CORRUPT
from pithy.sources import records
from pithy.sources.readers import read_pairs


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "400")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield spark
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def field(sep):
    """A field with everything that makes record boundaries hard."""
    bits = ["a", "word ", '""', "\n", "\n\n", sep, "é", "'", "x" * 30, "\r\n", " ", "\\"]
    kind = random.random()
    if kind < 0.3:
        return random.choice(["", "plain", " spaced ", 'in"side', "NA", "1.5"])
    return '"' + "".join(random.choice(bits) for _ in range(random.choice([0, 1, 5, 40]))) + '"'


def same_rows(spark, path, **options):
    ours, theirs = (read_pairs(spark, path, whole_files=w, **options) for w in (False, True))
    assert ours.schema.names == theirs.schema.names
    a, b = (sorted((tuple(r) for r in df.collect()), key=repr) for df in (ours, theirs))
    assert a == b
    return ours, a


@pytest.mark.parametrize("sep, suffix, seed", [(",", "csv", 1), ("\t", "tsv", 2), (",", "csv", 3)])
def test_rows_equal_the_whole_file_reader(small_splits, tmp_path, sep, suffix, seed):
    random.seed(seed)
    for n in range(3):
        rows = [sep.join([str(i), field(sep), field(sep), field(sep)]) for i in range(150)]
        rows[40:40] = ["", ""]
        (tmp_path / f"part{n}.{suffix}").write_text(sep.join(["id", "source", "article", "highlights"]) + "\n" + "\n".join(rows) + ("\n" if n else ""), newline="")
    ours, found = same_rows(small_splits, str(tmp_path / f"*.{suffix}"))
    assert len(found) == 450 and ours.rdd.getNumPartitions() > 20


def test_records_longer_than_splits(small_splits, tmp_path):
    long_ = '"' + "\n".join(f'line {i}, ""quoted""' for i in range(300)) + '"'
    text = "id,article,highlights\n" + "".join(f"{i},{long_ if i % 3 else 'short'},end\n" for i in range(12))
    (tmp_path / "long.csv").write_text(text)
    _, found = same_rows(small_splits, str(tmp_path / "long.csv"))
    assert len(found) == 12 and sum(r[1].count("\n") == 299 for r in found) == 8


def test_ragged_lines_are_labelled(small_splits, tmp_path):
    (tmp_path / "bad.csv").write_text('id,article,highlights\r\n1,a,b\r\n2,a\r\n3,a,b,c\r\n4,"x\r\ny",z\r\n\r\n5,"",\r\n')
    ours, found = same_rows(small_splits, str(tmp_path / "bad.csv"), label_corrupt=True)
    assert {r[0] for r in ours.where(f"{CORRUPT} is not null").collect()} == {"2", "3"} and len(found) == 5


def test_files_that_end_in_the_header_or_a_quote(small_splits, tmp_path):
    (tmp_path / "a.csv").write_text("id,article,highlights\n")
    (tmp_path / "b.csv").write_text('id,article,highlights\n1,"open,2\n3,4,5\n')
    _, found = same_rows(small_splits, str(tmp_path / "a.csv"))
    assert found == []
    assert read_pairs(small_splits, str(tmp_path / "b.csv")).count() == 1


def test_other_headers_are_refused(small_splits, tmp_path):
    (tmp_path / "a.csv").write_text("id,article,highlights\n1,a,b\n")
    (tmp_path / "b.csv").write_text("id,highlights,article\n2,a,b\n")
    with pytest.raises(Exception, match="does not name|header"):
        read_pairs(small_splits, str(tmp_path)+"/*.csv").collect()


def test_many_splits_are_sorted_instead_of_broadcast(small_splits, tmp_path, monkeypatch):
    monkeypatch.setattr(records, "BROADCAST_SPLITS", 1)
    random.seed(5)
    text = "id,article,highlights\n" + "".join(f"{i},{field(',')},{field(',')}\n" for i in range(200))
    (tmp_path / "many.csv").write_text(text, newline="")
    same_rows(small_splits, str(tmp_path / "many.csv"))
