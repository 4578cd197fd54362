"""Staged tables, and keys that tell nulls apart."""

import pytest
from pyspark.sql import functions as F

from tracewell.llm import mixing
from tracewell.llm.common import discard, stage


def test_discard_refuses_other_tables(spark, tmp_path):
    staged = stage(spark.range(10), "some")
    own = f"{tmp_path}/mine"
    staged.write.parquet(own)
    for df in (spark.read.parquet(own), spark.range(3), staged.unionByName(stage(spark.range(2), "other"))):
        with pytest.raises(ValueError):
            discard(df)
    assert spark.read.parquet(own).count() == 10
    files = staged.inputFiles()
    discard(staged)
    with pytest.raises(Exception, match="exist|FileNotFound|PATH_NOT_FOUND"):
        spark.read.parquet(files[0]).count()


def test_empty_table_can_be_discarded(spark):
    discard(stage(spark.range(0), "empty"))


def test_null_source_and_null_text_are_two_units(spark):
    docs = spark.createDataFrame([(1, None, "a"), (1, "a", None), (1, None, "a")], "doc_id long, source string, text string")
    keys = mixing.mix(docs).select("source", "size", "key").distinct().collect()
    assert len(keys) == 2 and len({r.key for r in keys}) == 2
    told = mixing.repeat(docs.withColumn("more", F.lit(1)))
    assert told.columns == ["doc_id", "source", "text", "more"]
    assert told.where("source IS NULL AND text = 'a'").count() % 2 == 0
