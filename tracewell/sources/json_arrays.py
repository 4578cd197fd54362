"""Scan of one large JSON array by byte ranges.

Spark's JSON reader takes a file whose root is an array as one record, in one task. Here the file is
read as pieces between commas, which Spark splits at any byte, and the pieces that make up an
element are found by a prefix scan: whether a piece begins inside a string follows from the quotes before
it, its depth from the brackets outside of strings before it. Both are summed up within each byte range first, then
over the ranges (a row each), so no task sees more than its own range.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracewell.operators import checks
from tracewell.operators.shared import shared_dir

#: The begin of an array, behind a byte order mark perhaps.
OPENS = r"^\x{FEFF}?\s*\["


def _count(text: Column, letters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, letters, ""))


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, i, piece, quotes, out, inside): out and inside are the brackets that a piece opens if it begins outside or inside a string."""
    raw = spark.read.option("lineSep", ",").text(path)
    placed = raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("i"), F.col("value").alias("piece"))
    # A backslash takes the next character with it, and a comma isn't one that it may take.
    plain = F.regexp_replace("piece", r"(?s)\\.", "")
    strings = lambda t: F.regexp_replace(t, r'"[^"]*(?:"|\z)', "")
    opened = lambda t: _count(t, "[{") - _count(t, "]}")
    # Most pieces are from the middle of a text: without a quote or bracket there is nothing to count.
    marked = reduce(Column.__or__, (F.contains("piece", F.lit(c)) for c in '"[]{}'))
    some = lambda count: F.when(F.col("marked"), count).otherwise(0)
    counted = placed.withColumn("marked", marked).withColumn("plain", F.when(F.col("marked"), plain))
    return counted.select("file", "block", "i", "piece", some(_count(F.col("plain"), '"')).alias("quotes"), some(opened(strings(F.col("plain")))).alias("out"), some(opened(strings(F.regexp_replace("plain", r'^[^"]*(?:"|\z)', "")))).alias("inside"))


def _kept(df: DataFrame) -> DataFrame:
    """A table in the shared folder, so that what it was made from isn't read again for it."""
    path = f"{shared_dir(df.sparkSession)}/tracewell/ranges-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _before(ranges: DataFrame, *names: str) -> DataFrame:
    """(file, block, names): sums over the earlier ranges of a file."""
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return ranges.select("file", "block", *(F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(n) for n in names))


def elements(spark: SparkSession, path: str) -> DataFrame:
    """(file, at, text): the elements of the array in each file, in any JSON, with their place from 0. Fails if a root is no array or doesn't end.

    The text of an element is as long as it is; all else of a task is bounded by its byte range. The
    file is read twice: for the state at each range's begin, and for its pieces, which are kept in the shared folder with the
    elements that end before them in their range. An empty array has no elements.
    """
    here = Window.partitionBy("file", "block").orderBy("i")
    earlier, so_far = here.rowsBetween(Window.unboundedPreceding, -1), here.rowsBetween(Window.unboundedPreceding, 0)
    pieces = _pieces(spark, path).withColumn("odd", F.pmod(F.coalesce(F.sum("quotes").over(earlier), F.lit(0)), F.lit(2)) == 1)
    # Brackets opened by a piece if its range begins outside of strings, and if it begins inside.
    pieces = pieces.withColumn("from_out", F.when(F.col("odd"), F.col("inside")).otherwise(F.col("out"))).withColumn("from_inside", F.when(F.col("odd"), F.col("out")).otherwise(F.col("inside")))
    sums = pieces.groupBy("file", "block").agg(*(F.sum(c).alias(c) for c in ("quotes", "from_out", "from_inside")))
    by_quotes = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    within = F.pmod(F.coalesce(F.sum("quotes").over(by_quotes), F.lit(0)), F.lit(2))
    states = _before(_kept(sums).select("file", "block", F.when(within == 1, F.col("from_inside")).otherwise(F.col("from_out")).alias("depth"), F.col("quotes").alias("quoted")), "depth", "quoted")
    joined = pieces.join(states, ["file", "block"])
    inside = F.pmod(F.col("quoted"), F.lit(2)) == 1
    opened = F.when(inside, F.col("from_inside")).otherwise(F.col("from_out"))
    ends_out = F.pmod(F.col("quoted") + F.col("odd").cast("int") + F.col("quotes"), F.lit(2)) == 0
    deep = joined.select("file", "block", "i", "piece", (F.col("depth") + F.sum(opened).over(so_far)).alias("depth"), ends_out.alias("ends_out"))
    # A comma outside of strings at depth 1 ends an element; behind the last piece of a file there is none.
    cut = F.col("ends_out") & (F.col("depth") == 1)
    deep = _kept(deep.select("file", "block", "i", "piece", "depth", "ends_out", cut.alias("cut"), F.count_if(cut).over(earlier).alias("cuts_here")))
    counts = _kept(deep.groupBy("file", "block").agg(F.count_if("cut").alias("cuts"), F.max("i").alias("i")))
    end = counts.groupBy("file").agg(F.max(F.struct("block", "i")).alias("end"))
    placed = deep.join(_before(counts, "cuts"), ["file", "block"]).withColumn("at", F.col("cuts") + F.col("cuts_here"))
    parts = F.array_sort(F.collect_list(F.struct("block", "i", "piece")))
    last = F.max(F.struct("block", "i", "depth", "ends_out")).alias("last")
    whole = placed.groupBy("file", "at").agg(F.array_join(F.transform(parts, lambda p: p.piece), ",").alias("text"), last).join(end, "file")
    final = F.struct("last.block", "last.i") == F.col("end")
    bare = F.when(F.col("at") == 0, F.regexp_replace("text", OPENS, "")).otherwise(F.col("text"))
    bare = F.when(final, F.regexp_replace(bare, r"\]\s*\z", "")).otherwise(bare)
    begun = (F.col("at") > 0) | F.col("text").rlike(OPENS)
    ended = ~final | ((F.col("last.depth") == 0) & F.col("last.ends_out") & F.col("text").rlike(r"\]\s*\z"))
    wrong = F.raise_error(F.concat(F.lit("the root is no whole array: "), "file")).cast("string")
    checked = whole.select("file", "at", F.when(begun & ended, bare).otherwise(wrong).alias("text"))
    return checked.where(~((F.col("at") == 0) & F.col("text").rlike(r"^\s*\z")))


def scan_objects(spark: SparkSession, path: str) -> DataFrame:
    """(node): the objects in the arrays as variants, as feeds.scan_json() gives them; other elements are left out, and malformed ones are an error."""
    rows = elements(spark, path)
    if spark.read.option("lineSep", ",").text(path).isEmpty():
        raise checks.CheckFailed(f"feed root is an array: {path} is empty")
    return rows.select(F.parse_json("text").alias("node")).where(F.schema_of_variant("node").startswith("OBJECT"))
