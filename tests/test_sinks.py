from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from socialog.sources import sinks, tables


def files(path):
    return sorted(Path(path).glob("*.parquet"))


@pytest.mark.parametrize("profile", sinks.PROFILES)
def test_row_groups_follow_the_profile(spark, tmp_path, profile):
    limit = sinks.PROFILES[profile].row_group_rows
    path = str(tmp_path / profile)
    sinks.write_tuned(spark.range(0, 2 * limit + 10, 1, 1), path, profile)
    (file,) = files(path)
    meta = pq.ParquetFile(file).metadata
    sizes = [meta.row_group(i).num_rows for i in range(meta.num_row_groups)]
    assert sizes == [limit, limit, 10]
    assert meta.row_group(0).column(0).compression == "SNAPPY"


def test_batches_split_files_on_request(spark, tmp_path):
    path = str(tmp_path / "split")
    sinks.write_tuned(spark.range(0, 12_000, 1, 1), path, "small", split_batches=True)
    assert sorted(pq.ParquetFile(f).metadata.num_rows for f in files(path)) == [2000, 5000, 5000]


def test_export_is_zstd(spark, tmp_path):
    sinks.export_zstd(spark.range(100), str(tmp_path / "z"))
    meta = pq.ParquetFile(files(tmp_path / "z")[-1]).metadata
    assert meta.row_group(0).column(0).compression == "ZSTD"


def test_parts_are_even(spark, tmp_path):
    sinks.write_parts(spark.range(1003), str(tmp_path / "p"), 4)
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in files(tmp_path / "p")]
    assert sum(sizes) == 1003 and len(sizes) == 4 and max(sizes) - min(sizes) <= 8


def test_compaction_keeps_all_rows(spark, tmp_path):
    small, large = str(tmp_path / "small"), str(tmp_path / "large")
    spark.range(0, 500, 1, 20).write.parquet(small)
    sinks.compact(spark, small, large, 3)
    assert len(files(small)) == 20 and len(files(large)) == 3
    assert spark.read.parquet(large).agg(F.sum("id")).first()[0] == sum(range(500))


def test_compaction_sizes_itself(spark, tmp_path):
    small = str(tmp_path / "small")
    spark.range(0, 40_000, 1, 10).write.parquet(small)
    total = sum(f.stat().st_size for f in files(small))
    assert sinks.parts_for(spark, small) == 1
    assert sinks.parts_for(spark, small, total // 3) in (3, 4)
    assert sinks.parts_for(spark, small, total) == 1


def test_clustering_splits_a_hot_key_and_narrows_row_groups(spark, tmp_path, many_tasks):
    hot = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000)
    df = spark.range(30_000).select(hot.alias("Fid"), F.col("id").alias("Timestamp"))
    sinks.clustered(df, "Fid", "Timestamp").write.parquet(str(tmp_path / "c"))
    ranges = []
    for file in files(tmp_path / "c"):
        stats = pq.ParquetFile(file).metadata.row_group(0).column(0).statistics
        ranges.append((stats.min, stats.max))
    ranges.sort()
    assert len(ranges) > 1
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))


def test_csv_has_no_header(spark, tmp_path):
    df = spark.createDataFrame([(1, "0xaa"), (2, "")], "FID bigint, Address string").coalesce(1)
    sinks.write_csv(df, str(tmp_path / "c"))
    (file,) = Path(tmp_path / "c").glob("*.csv")
    assert file.read_text().splitlines()[0] == "1,0xaa"


def test_statistics_name_each_file(spark, tmp_path):
    path = str(tmp_path / "s")
    spark.range(0, 300, 1, 3).write.parquet(path)
    rows = sinks.write_statistics(spark, path).collect()
    assert sorted(r["rows"] for r in rows) == [100, 100, 100]
    by_name = {Path(r["file_path"].removeprefix("file:")).name: r["file_bytes"] for r in rows}
    assert by_name == {f.name: f.stat().st_size for f in files(path)}
    assert {r["plain_bytes"] for r in rows} == {800}


def test_scan_skips_folders_left_by_writers(spark, tmp_path):
    from helpers import flat

    path = str(tmp_path / "log")
    row = flat(spark, "links", [{"Fid": 1}])
    row.write.parquet(path)
    row.write.parquet(f"{path}/temp_x/worker_0")
    assert tables.scan_log(spark, path, "links").count() == 1
