"""Chunks as files."""

from pyspark.sql import functions as F

from millrace.operators import mixture
from millrace.sources import files, scans, sinks


def test_a_file_for_each_chunk(spark, tmp_path):
    """As many files as chunks, each holding one whole chunk."""
    path = str(tmp_path / "chunks")
    rows = spark.range(1050).select("id", F.col("id").cast("string").alias("text"))
    sinks.write_chunks(rows, path, 100, "id")
    assert len(files.parquet_files(path)) == 11
    got = scans.read(spark, path).select("*", F.input_file_name().alias("file")).join(mixture.chunks(rows.select("id"), 100, "id"), "id")
    assert got.count() == 1050 and got.select("file", "chunk").distinct().count() == 11


def test_merged_chunks_are_as_many_files(spark):
    from millrace.plans.registry import QUERIES

    df = QUERIES["chunk_merge"](spark, "/root/testdata/sf0.01")
    assert df.count() == 1000 and len(df.inputFiles()) == 5
