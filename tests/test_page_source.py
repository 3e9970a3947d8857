"""The page source: whole writes, failed writes, pruned reads, damaged files."""

import time

import pytest
from pyspark.sql import functions as F

from chainfold.sources import page_source as S


def pages(spark, first, last):
    return spark.range(first * 10, last * 10).select(
        F.expr("id div 10").alias("page"), F.lit("a").alias("address"), F.format_string("%06d", "id").alias("slot"), F.lit("v").alias("value"))


def read(spark, path, **options):
    return spark.read.format(S.NAME).options(**options).load(path)


def test_round_trip_pruning_and_failed_writes(spark, tmp_path):
    S.register(spark)
    path = str(tmp_path / "pages")
    assert read(spark, path).count() == 0
    write = lambda rows, mode="append": rows.write.format(S.NAME).mode(mode).save(path)
    write(pages(spark, 0, 40).repartitionByRange(4, "page"))
    assert sorted(map(tuple, read(spark, path).collect())) == sorted(map(tuple, pages(spark, 0, 40).collect()))
    before = sorted(p.name for p in (tmp_path / "pages" / "files").iterdir())
    broken = pages(spark, 40, 60).repartitionByRange(4, "page").withColumn(
        "value", F.when(F.col("page") == 57, F.raise_error(F.lit("a task fails")).cast("string")).otherwise(F.col("value")))
    with pytest.raises(Exception, match="a task fails"):
        write(broken)
    assert read(spark, path).count() == 400
    time.sleep(2)                               # tasks that were still running when the job failed
    S.sweep(path)
    assert sorted(p.name for p in (tmp_path / "pages" / "files").iterdir()) == before and S.sweep(path) == 0
    with pytest.raises(Exception, match="not replaced"):
        write(pages(spark, 0, 1), "overwrite")
    write(pages(spark, 40, 50))
    write(pages(spark, 0, 1).limit(0))
    assert read(spark, path).count() == 500
    for condition, n in (("page = 12", 10), ("page > 12 AND page <= 14", 20), ("page IN (3, 47)", 20), ("page < 0", 0), ("slot = '000007'", 1)):
        assert read(spark, path).where(condition).count() == n, condition
    reader = S.PageReader(path, True)
    list(reader.pushFilters([S.EqualTo(("page",), 12)]))
    assert len(reader.partitions()) == 1 and len(S.PageReader(path, True).partitions()) == len(S.manifest_files(path)) >= 5


def test_a_damaged_file_is_refused(spark, tmp_path):
    S.register(spark)
    path = str(tmp_path / "pages")
    pages(spark, 0, 5).coalesce(1).write.format(S.NAME).mode("append").save(path)
    file = next((tmp_path / "pages" / "files").iterdir())
    other = str(tmp_path / "other")
    pages(spark, 1, 6).coalesce(1).write.format(S.NAME).mode("append").save(other)
    file.write_bytes(next((tmp_path / "other" / "files").iterdir()).read_bytes())
    with pytest.raises(Exception, match="committed"):
        read(spark, path).collect()
    assert read(spark, path, verify="false").count() == 50
