"""Tables kept as a base and the changes since: what is written follows the changes, and readers merge.

A table is a folder with a base (all rows), change sets (the last state of each key that changed) and the digests
of its buckets, each a Parquet table under a name of its own; the pointer that was published
last names those that count. Rows are dealt into buckets by a hash of their keys and lie in the order of
buckets, so that a reader of some buckets skips the others' row groups.

A bucket's digest is a count and two 64-bit sums modulo 2 of its rows' hashes, so it follows from
the digest before and the rows that came and went.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from tracewell.operators import checks, sinks

#: Buckets of a table, and change sets after which they are merged into a new base.
BUCKETS, FOLD = 256, 16
#: Columns of a change set beside the table's: the bucket, put or cut, and the hashes of the row before (0 if there was none).
OWN = ("_bucket", "_op", "_old_a", "_old_b")
DIGEST = ("rows", "a", "b")


def bucketed(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """df with the bucket of each row."""
    return df.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int"))


def row_hash(seed: int, columns: list[str]) -> Column:
    """A 64-bit hash of the columns as text, in order of their names; nulls count."""
    parts = [x for c in sorted(columns) for x in (F.col(c).isNull(), F.col(c).cast("string"))]
    return F.xxhash64(F.lit(seed), *parts)


def digests(rows: DataFrame, columns: list[str], groups: list[str], *more: Column) -> DataFrame:
    """(groups, _bucket, rows, a, b, more) of bucketed rows: one scan, summed up within tasks before the shuffle."""
    sums = [F.bit_xor(row_hash(i, columns)).alias(name) for i, name in enumerate("ab")]
    return rows.groupBy(*groups, "_bucket").agg(F.count(F.lit(1)).alias("rows"), *sums, *more)


def differing(one: DataFrame, other: DataFrame, groups: list[str]) -> DataFrame:
    """(groups, _bucket) whose digests differ, or that only one side has. Groups with equal sums over all buckets are left out first."""

    def sums(df: DataFrame) -> DataFrame:
        placed = [F.bit_xor(F.xxhash64("_bucket", "rows", c)).alias(c) for c in ("a", "b")]
        return df.groupBy(*groups).agg(F.sum("rows").alias("rows"), *placed)

    def unequal(x: DataFrame, y: DataFrame, on: list[str]) -> DataFrame:
        state = lambda name: F.struct(*DIGEST).alias(name)
        both = x.select(*on, state("_x")).join(y.select(*on, state("_y")), on, "full")
        return both.where(~F.col("_x").eqNullSafe(F.col("_y"))).select(*on)

    if groups:
        roots = unequal(sums(one), sums(other), groups)
        one, other = (x.join(roots, groups, "left_semi") for x in (one, other))
    return unequal(one, other, [*groups, "_bucket"])


def _parquet(spark: SparkSession, path: str, version: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{version}")


def _complete(parts: dict[str, tuple[DataFrame, int]]) -> None:
    """Fails unless each part has as many rows as its pointer says. Only files' footers are read."""
    if parts:
        counts = sinks.manifest_counts({name: df.select() for name, (df, _) in parts.items()})
        expected = F.create_map(*(F.lit(x) for name, (_, n) in parts.items() for x in (name, n)))
        checks.enforce("the read is complete", counts.where(F.col("n") != expected[F.col("name")]))


def read(spark: SparkSession, path: str, schema=None, pointer: Row | None = None, buckets: list[int] | None = None, check: bool = True) -> DataFrame:
    """The table's rows as the pointer (the current one) says, checked to be complete; without a pointer an empty table of the schema.

    Rows of the base whose keys changed give way to the last change; where changes are few, Spark
    broadcasts them and the base isn't shuffled. buckets: only these are read.
    """
    pointer = pointer or sinks.current(spark, path)
    if pointer is None:
        return spark.createDataFrame([], schema)
    some = lambda df: df if buckets is None else df.where(F.col("_bucket").isin(buckets))
    keys, changes = pointer["keys"], [(c.version, c.n) for c in pointer.changes or []]
    parts = {v: (_parquet(spark, path, v), n) for v, n in [*([(pointer.version, pointer.n)] if pointer.version else []), *changes]}
    if check:
        _complete(parts)
    columns = [c for c in next(iter(parts.values()))[0].columns if c not in OWN]
    base = some(parts[pointer.version][0]).select(*columns) if pointer.version else None
    if not changes:
        return base
    rest = [c for c in columns if c not in keys]
    log = None
    for at, (version, _) in enumerate(changes):
        one = some(parts[version][0]).select(*keys, F.struct(F.lit(at).alias("_at"), "_op", *rest).alias("_last"))
        log = one if log is None else log.unionByName(one)
    last = log.groupBy(*keys).agg(F.max_by("_last", F.col("_last._at")).alias("_last")) if len(changes) > 1 else log
    put = last.where("_last._op = 'put'").select(*(F.col(c) if c in keys else F.col(f"_last.{c}").alias(c) for c in columns))
    return base.join(last.select(*keys), keys, "left_anti").unionByName(put) if base is not None else put


def stored_digests(spark: SparkSession, path: str, pointer: Row | None, schema, keys: tuple[str, ...], groups: list[str]) -> DataFrame:
    """Digests of the current rows, which each version keeps."""
    if pointer is not None:
        return _parquet(spark, path, pointer.digests)
    empty = spark.createDataFrame([], schema)
    return digests(bucketed(empty, keys), empty.columns, groups)


def save(df: DataFrame, path: str, keys: tuple[str, ...], max_records: int = 0) -> None:
    """Writes bucketed rows in the order of buckets, so that each row group of a large file has few of them; buckets are dealt out in parts."""
    part = F.pmod(F.xxhash64(F.lit("part"), *keys), F.lit(16))
    laid = df.repartition("_bucket", part).sortWithinPartitions("_bucket", *keys)
    (laid.write.option("maxRecordsPerFile", max_records) if max_records else laid.write).parquet(path)


Writer = Callable[[DataFrame, str], None]


def write_base(df: DataFrame, path: str, keys: tuple[str, ...], groups: list[str], before: Row | None, max_records: int = 0) -> int:
    """Writes all rows as a new base, checks it by digests that the writing job itself takes, and publishes it; rows written.

    An interrupted write changes nothing. Of two writers that go on from one version, one gets a Conflict.
    """
    spark, version, summed = df.sparkSession, f"base-{uuid.uuid4().hex}", f"digests-{uuid.uuid4().hex}"
    total = lambda: [F.count(F.lit(1)).alias("rows"), *(F.bit_xor(row_hash(i, df.columns)).alias(name) for i, name in enumerate("ab"))]
    seen = Observation()
    save(bucketed(df.observe(seen, *total()), keys), f"{path}/{version}", keys, max_records)
    written = _parquet(spark, path, version)
    digests(written, df.columns, groups).write.parquet(f"{path}/{summed}")
    row = _parquet(spark, path, summed).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b")).first()
    if row.asDict() != seen.get:
        raise checks.CheckFailed(f"the written table is the wanted one: {row.asDict()} instead of {seen.get}")
    sinks.publish(spark, path, version, row.rows, before, keys, digests=summed)
    return row.rows


def compact(spark: SparkSession, path: str, groups: list[str], max_records: int = 0) -> bool:
    """Merges base and changes into a new base; whether there was anything to merge. The rows stay the same."""
    before = sinks.current(spark, path)
    if before is None or not before.changes:
        return False
    write_base(read(spark, path, pointer=before), path, tuple(before["keys"]), groups, before, max_records)
    return True


def after(have: DataFrame, changes: DataFrame, columns: list[str], groups: list[str]) -> DataFrame:
    """Digests after the changes, from those before and the change sets' rows alone."""
    came = F.col("_op") == "put"
    went = (F.col("_old_a") != 0) | (F.col("_old_b") != 0)
    plus, zero = F.when(came, 1).otherwise(0) - F.when(went, 1).otherwise(0), F.lit(0).cast("bigint")
    sums = [F.bit_xor(F.when(came, row_hash(i, columns)).otherwise(zero).bitwiseXOR(F.col(f"_old_{name}"))).alias(name) for i, name in enumerate("ab")]
    delta = changes.groupBy(*groups, "_bucket").agg(F.sum(plus.cast("bigint")).alias("rows"), *sums)
    total = have.select(*groups, "_bucket", *DIGEST).unionByName(delta).groupBy(*groups, "_bucket")
    return total.agg(F.sum("rows").alias("rows"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b")).where("rows <> 0 OR a <> 0 OR b <> 0")


def changed(desired: DataFrame, current: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The change set, with OWN, that makes current of desired."""
    rest = [c for c in desired.columns if c not in keys]
    row = lambda name: F.struct(F.lit(True).alias("_there"), *rest).alias(name)
    old = current.select(*keys, row("_old"), *(row_hash(i, desired.columns).alias(f"_old_{name}") for i, name in enumerate("ab")))
    both = desired.select(*keys, row("_new")).join(old, list(keys), "full").where(~F.col("_new").eqNullSafe(F.col("_old")))
    columns = [F.col(c) if c in keys else F.col(f"_new.{c}").alias(c) for c in desired.columns]
    op = F.when(F.col("_new").isNull(), "cut").otherwise("put").alias("_op")
    zero = F.lit(0).cast("bigint")
    return bucketed(both.select(*columns, op, F.coalesce("_old_a", zero).alias("_old_a"), F.coalesce("_old_b", zero).alias("_old_b")), keys)


def wrong(have: DataFrame, changes: DataFrame, want: DataFrame, columns: list[str], groups: list[str]) -> DataFrame:
    """(groups) whose digests, after the changes as they were written, aren't the wanted ones; without groups (_bucket)."""
    if not groups:
        return differing(after(have, changes, columns, groups), want, groups)
    mine = after(have.join(want.select(*groups).distinct(), groups, "left_semi"), changes, columns, groups)
    return differing(mine, want, groups).select(*groups).distinct()


def append(spark: SparkSession, path: str, version: str, keys: tuple[str, ...], columns: list[str], groups: list[str], have: DataFrame, before: Row | None) -> int:
    """Publishes a change set that was written under path; its rows. One without rows isn't published."""
    written = _parquet(spark, path, version)
    n = written.select().count()
    if n:
        summed = f"digests-{uuid.uuid4().hex}"
        after(have, written, columns, groups).write.parquet(f"{path}/{summed}")
        earlier = [(c.version, c.n) for c in before.changes or []] if before else []
        sinks.publish(spark, path, before.version if before else None, before.n if before else 0, before, keys, [*earlier, (version, n)], summed)
    return n
