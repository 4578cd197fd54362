"""Checks of tables. Each gives the rows that violate it; enforce() fails if there are any."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class CheckFailed(ValueError):
    """A table or feed isn't as it has to be."""


class Conflict(CheckFailed):
    """Another writer published the next version first; nothing of this one was changed."""


def enforce(what: str, violations: DataFrame) -> None:
    """Fails with the first violations, of which a few go to the driver."""
    if found := violations.limit(3).collect():
        raise CheckFailed(f"{what}: {found}")


def header_has(columns: list[str], required: tuple[str, ...]) -> None:
    if missing := set(required) - set(columns):
        raise CheckFailed(f"columns are missing: {sorted(missing)}")


def header_is(columns: list[str], expected: tuple[str, ...]) -> None:
    if tuple(columns) != tuple(expected):
        raise CheckFailed(f"columns are {columns}, not {list(expected)}")


def no_other_columns(columns: list[str], fields: tuple[str, ...], internal: tuple[str, ...] = ()) -> None:
    if other := set(columns) - set(fields) - set(internal):
        raise CheckFailed(f"unexpected columns: {sorted(other)}")


def empty(df: DataFrame) -> DataFrame:
    """One row (n = 0) if df is empty."""
    return df.agg(F.count(F.lit(1)).alias("n")).where("n = 0")


def blank_key(keys: tuple[str, ...]) -> Column:
    """Whether a part of the key is null or ''."""
    blank = F.lit(False)
    for k in keys:
        blank = blank | F.col(k).isNull() | (F.col(k).cast("string") == "")
    return blank


def key_violations(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """(keys, n, violation): keys with a blank part, and keys of more than one row."""
    blank = blank_key(keys)
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    kind = F.when(blank, "empty key").when(F.col("n") > 1, "duplicate key")
    return counted.withColumn("violation", kind).where("violation IS NOT NULL")


def key_summary(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """One row (n, flawed): rows, and keys that key_violations() would list."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count_if(blank_key(keys) | (F.col("n") > 1)).alias("flawed"))


def file_hashes(spark, path: str) -> DataFrame:
    """(path, length, sha256) of files."""
    return spark.read.format("binaryFile").load(path).select("path", "length", F.sha2("content", 256).alias("sha256"))


def size_violations(spark, path: str, most: int) -> DataFrame:
    """Files that are empty or larger than `most` bytes; the contents aren't read. A scan leaves empty files out, a listing doesn't."""
    found = spark.read.format("binaryFile").load(path).select("path", "length")
    plain = lambda c: F.regexp_replace(c, r"^([\w.-]+):/+", "$1:/")
    listed = spark.createDataFrame([(f,) for f in found.inputFiles()], "path string")  # a feed is a few files
    sized = listed.select(plain("path").alias("path")).join(found.select(plain("path").alias("path"), "length"), "path", "left")
    return sized.select("path", F.coalesce("length", F.lit(0)).alias("length")).where((F.col("length") == 0) | (F.col("length") > most))


def whole_number(value: Column) -> Column:
    """The integer that a text of a manifest is, null if it is none."""
    return F.try_to_number(value, F.lit("999999999999999999")).cast("bigint")


def count_mismatch(counts: DataFrame, manifest: DataFrame) -> DataFrame:
    """(name, n, expected) where a table's count isn't the manifest's integer. counts: (name, n); manifest: (key, value)."""
    expected = whole_number(F.col("value"))
    joined = counts.join(manifest.select(F.col("key").alias("name"), expected.alias("expected")), "name", "left")
    return joined.where(~F.col("n").eqNullSafe(F.col("expected")))


def delete_guard(counts: DataFrame, limit: float = 0.25, override: bool = False) -> DataFrame:
    """Rows of counts (groups…, n_current, n_stale) whose stale share is over the limit; none with the override."""
    over = (F.col("n_stale") > 0) & (F.col("n_current") > 0) & (F.col("n_stale") / F.col("n_current") > limit)
    return counts.where(F.lit(False) if override else over)
