from pathlib import Path

import pytest
from pyspark.sql import functions as F

from socialog import session


@pytest.fixture
def stored(spark, tmp_path):
    folder = tmp_path / "t"
    spark.range(0, 50_000, 1, 5).write.parquet(str(folder))
    return folder


def test_stored_bytes_are_those_of_the_files(spark, stored):
    want = sum(f.stat().st_size for f in Path(stored).glob("*.parquet"))
    assert session.stored_bytes(spark, str(stored)) == want


def test_shuffles_grow_with_the_input(spark, stored, settings):
    settings({"spark.sql.shuffle.partitions": "4"})
    few = session.size_shuffles(spark, str(stored))
    many = session.size_shuffles(spark, str(stored), part_bytes=1000)
    assert few == spark.sparkContext.defaultParallelism
    assert many > 100
    assert spark.conf.get("spark.sql.shuffle.partitions") == str(many)


def test_written_keeps_rows_and_schema(spark):
    df = spark.range(10).select("id", F.lit(None).cast("string").alias("blank"))
    back = session.written(df, "copy")
    assert back.schema.names == df.schema.names and back.count() == 10
    assert session.shared_folder(spark) in back.inputFiles()[0]


def test_scratch_tables_go_and_kept_ones_stay(spark):
    def path(df):
        return Path(df.inputFiles()[0].removeprefix("file://")).parent

    with session.scratch(spark):
        outer = path(session.written(spark.range(3), "outer"))
        with session.scratch(spark):
            inner = path(session.written(spark.range(3), "inner"))
            kept = session.written(spark.range(3), "kept", keep=True)
        assert not inner.exists() and outer.exists() and kept.count() == 3
        last = session.written(spark.range(4), "last", keep=True)
    assert not outer.exists() and not path_exists(kept) and last.count() == 4
    with pytest.raises(ZeroDivisionError), session.scratch(spark):
        lost = path(session.written(spark.range(3), "lost"))
        raise ZeroDivisionError
    assert not lost.exists()


def path_exists(df):
    return Path(df.inputFiles()[0].removeprefix("file://")).exists()


def test_folders_are_never_shared_by_two_runs(spark):
    assert session.new_path(spark, "x") != session.new_path(spark, "x")
