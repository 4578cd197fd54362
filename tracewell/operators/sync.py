"""Keyed sync of tables for many tenants at once: plan, guard, apply, verify, report.

Tenant and dataset are key columns, so all tenants are one job; a group that fails a check, or whose
rows aren't right as they were written, becomes a status row and keeps its current rows. A table is changed by
writing what changed and moving a pointer, so readers see the old rows or the new ones, never a mixture.

Both sides are summed up by buckets of keys first (changelog.digests). Only buckets that differ are
joined, so a sync costs two scans of the desired rows, and work that follows the changes.
"""

from __future__ import annotations

import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.operators import changelog, checks, sinks


def plan_changes(desired: DataFrame, current: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """(keys, op, new): op is insert, update, stale or same; new is the desired row, null for stale.

    Both sides have the same columns; keys are unique and not null. A null in another column equals a null.
    """
    rest = [c for c in desired.columns if c not in keys]
    row = lambda name: F.struct(F.lit(True).alias("_there"), *rest).alias(name)
    both = desired.select(*keys, row("_new")).join(current.select(*keys, row("_old")), list(keys), "full")
    op = F.when(F.col("_old").isNull(), "insert").when(F.col("_new").isNull(), "stale").when(F.col("_new").eqNullSafe(F.col("_old")), "same").otherwise("update")
    return both.select(*keys, op.alias("op"), F.when(F.col("_new").isNotNull(), F.struct(*(F.col(f"_new.{c}").alias(c) for c in rest))).alias("new"))


def reconcile(desired: DataFrame, current: DataFrame, keys: tuple[str, ...], groups: list[str] | None = None) -> DataFrame:
    """plan_changes() of the rows that change, without those that stay the same.

    Digests of both sides' buckets, a scan each without a shuffle of rows, tell which buckets differ; only
    their rows are joined. The numbers of these buckets go to the driver, changelog.BUCKETS at most.
    """
    sides = [changelog.bucketed(x, keys) for x in (desired, current)]
    buckets = _differing(*(changelog.digests(x, desired.columns, groups or []) for x in sides), groups or [])
    some = [x.where(F.col("_bucket").isin(buckets)).select(*desired.columns) for x in sides]
    return plan_changes(*some, keys).where("op <> 'same'")


def _differing(want: DataFrame, have: DataFrame, groups: list[str]) -> list[int]:
    """Numbers of the buckets that differ, changelog.BUCKETS at most."""
    return sorted(r[0] for r in changelog.differing(want, have, groups).select("_bucket").distinct().collect())


def change_counts(plan: DataFrame, groups: list[str] | None = None) -> DataFrame:
    """Per group: n_upsert, n_stale, n_current, n_desired."""
    n = lambda *ops: F.count_if(F.col("op").isin(*ops)).cast("bigint")
    return plan.groupBy(*(groups or [])).agg(n("insert", "update").alias("n_upsert"), n("stale").alias("n_stale"), n("update", "stale", "same").alias("n_current"), n("insert", "update", "same").alias("n_desired"))


def apply_changes(plan: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The table after the plan: all desired rows."""
    return plan.where("op <> 'stale'").select(*keys, "new.*")


def verify_diff(actual: DataFrame, desired: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """One row (missing, extra, changed): how the actual table differs from the desired one."""
    plan = plan_changes(desired, actual, keys)
    n = lambda op: F.count_if(F.col("op") == op).cast("bigint")
    return plan.agg(n("insert").alias("missing"), n("stale").alias("extra"), n("update").alias("changed"))


def tenant_report(plan: DataFrame, groups: list[str], limit: float = 0.25, override: bool = False) -> DataFrame:
    """Per group the change counts and its status: ok, or guarded if it would delete over `limit` of its rows."""
    counts = change_counts(plan, groups)
    guarded = checks.delete_guard(counts, limit, override).select(*groups, F.lit("guarded").alias("_status"))
    return counts.join(guarded, groups, "left").select(*groups, "n_upsert", "n_stale", "n_current", "n_desired", F.coalesce("_status", F.lit("ok")).alias("status"))


def sync_tenants(desired: DataFrame, current: DataFrame, groups: list[str], keys: tuple[str, ...], limit: float = 0.25, override: bool = False) -> tuple[DataFrame, DataFrame]:
    """(next version, report): groups with filled, unique keys that pass the guard get their desired rows, the others keep what they have.

    keys begin with the groups. Status: ok, guarded, or bad keys, whose changes aren't counted.
    """
    bad = checks.key_violations(desired, tuple(keys)).select(*groups).distinct()
    plan = plan_changes(desired.join(bad, groups, "left_anti"), current.join(bad, groups, "left_anti"), tuple(keys))
    report = tenant_report(plan, groups, limit, override)
    n = lambda df, name: df.join(bad, groups, "left_semi").groupBy(*groups).agg(F.count(F.lit(1)).alias(name))
    zero = F.lit(0).cast("bigint")
    flawed = n(desired, "n_desired").join(n(current, "n_current"), groups, "left").select(*groups, zero.alias("n_upsert"), zero.alias("n_stale"), F.coalesce("n_current", zero).alias("n_current"), "n_desired", F.lit("bad keys").alias("status"))
    report = report.unionByName(flawed)
    passed = report.where("status = 'ok'").select(*groups)
    new = apply_changes(plan, tuple(keys)).join(passed, groups, "left_semi")
    kept = current.join(passed, groups, "left_anti")
    return new.unionByName(kept.select(*new.columns)), report


REPORT = ("n_upsert", "n_stale", "n_current", "n_desired", "status")


def _staged(df: DataFrame, folder: str) -> DataFrame:
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _report(want: DataFrame, have: DataFrame, plan: DataFrame, bad: DataFrame, groups: list[str], limit: float, override: bool) -> DataFrame:
    """(groups, REPORT), one row a group, made on the driver; ok, bad keys or guarded."""
    ops = plan.groupBy(*groups).agg(F.count_if(F.col("_op") == "put").alias("n_upsert"), F.count_if(F.col("_op") == "cut").alias("n_stale"))
    rows = lambda df, name: df.groupBy(*groups).agg(F.sum("rows").alias(name))
    counts = rows(want, "n_desired").join(rows(have, "n_current"), groups, "left").join(ops, groups, "left").join(bad.withColumn("_bad", F.lit(True)), groups, "left")
    counts = counts.select(*groups, *(F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in REPORT[:-1]), F.coalesce("_bad", F.lit(False)).alias("_bad"))
    guarded = checks.delete_guard(counts, limit, override).select(*groups, F.lit("guarded").alias("_status"))
    status = F.when(F.col("_bad"), "bad keys").otherwise(F.coalesce("_status", F.lit("ok"))).alias("status")
    told = counts.join(guarded, groups, "left").select(*groups, *REPORT[:-1], status)
    return want.sparkSession.createDataFrame(told.orderBy(*groups).collect(), told.schema)


def _marked(told: DataFrame, some: DataFrame, groups: list[str], status: str) -> DataFrame:
    """The report, in order, with another status for some groups that were ok."""
    marked = told.join(some.withColumn("_new", F.lit(status)), groups, "left")
    new = F.when(F.col("status") == "ok", F.coalesce("_new", "status")).otherwise(F.col("status"))
    return marked.withColumn("status", new).select(*told.columns).orderBy(*groups)


def sync_all(
    desired: DataFrame, path: str, groups: list[str], keys: tuple[str, ...], limit: float = 0.25, override: bool = False,
    max_records: int = 0, dry_run: bool = False, write: changelog.Writer | None = None,
) -> DataFrame:
    """Brings the table at path, which holds the rows of all groups, to the desired rows; returns the report, in the order of the groups.

    keys begin with the groups, whose columns aren't null. Status of a group:

    - ok: it has its desired rows;
    - bad keys, guarded: it keeps its rows, since keys are blank or repeated (its changes aren't counted), or too many would go;
    - verify failed: it keeps its rows, since its changes weren't right as they were written;
    - conflict: another writer published first, and no group has changed.

    A group of which nothing is desired keeps its rows. What is written follows the changes; after
    changelog.FOLD change sets the table is merged. max_records: rows of a file at most; write(rows, folder): how
    the changes get to a folder, by default in the order of their buckets.
    """
    spark, columns = desired.sparkSession, desired.columns
    before = sinks.current(spark, path)
    current = changelog.read(spark, path, desired.schema, before)
    checks.no_other_columns(current.columns, tuple(columns))
    work = f"{path}/_work-{uuid.uuid4().hex}"
    put = write or (lambda rows, folder: changelog.save(rows, folder, keys, max_records))
    try:
        wanted = changelog.bucketed(desired, keys)
        want = _staged(changelog.digests(wanted, columns, groups, F.count_if(checks.blank_key(keys)).alias("blank")), f"{work}/want")
        checks.enforce("groups are filled", want.where(" OR ".join(f"`{g}` IS NULL" for g in groups)))
        stored = changelog.stored_digests(spark, path, before, desired.schema, keys, groups)
        have = stored.join(want.select(*groups).distinct(), groups, "left_semi")
        buckets = _differing(want.drop("blank"), have, groups)
        some = _staged(wanted.where(F.col("_bucket").isin(buckets)).select(*columns), f"{work}/some")
        # A repeated key makes its bucket differ, since the table's keys are unique.
        bad = _staged(checks.key_violations(some, tuple(keys)).select(*groups).unionByName(want.where("blank > 0").select(*groups)).distinct(), f"{work}/bad")
        good = want.select(*groups).distinct().join(bad, groups, "left_anti")
        there = changelog.read(spark, path, desired.schema, before, buckets, check=False).select(*columns)
        changes = changelog.changed(some.join(bad, groups, "left_anti"), there.join(good, groups, "left_semi"), keys)
        plan = _staged(changes, f"{work}/plan")
        told = _report(want, have, plan, bad, groups, limit, override)
        if dry_run:
            return told.orderBy(*groups)
        want, failed = want.drop("blank"), told.where("false").select(*groups)
        # A second time only if changes of a group weren't right: then without it.
        for attempt in range(2):
            passed = told.where("status = 'ok'").select(*groups).join(failed, groups, "left_anti")
            version = f"changes-{uuid.uuid4().hex}"
            put(plan.join(passed, groups, "left_semi"), f"{path}/{version}")
            written = spark.read.schema(plan.schema).parquet(f"{path}/{version}")
            wrong = changelog.wrong(have, written, want.join(passed, groups, "left_semi"), columns, groups).collect()  # a row a group
            if not wrong:
                break
            sinks.remove(spark, f"{path}/{version}")
            if attempt:
                raise checks.CheckFailed(f"the written changes aren't the wanted ones: {wrong[:3]}")
            failed = spark.createDataFrame(wrong, failed.schema)
        try:
            n = changelog.append(spark, path, version, keys, columns, groups, stored, before)
        except checks.Conflict:
            n, failed = 0, None
        if not n:
            sinks.remove(spark, f"{path}/{version}")
        if failed is None:
            return _marked(told, told.select(*groups), groups, "conflict")
    finally:
        sinks.remove(spark, work)
    if before and len(before.changes or []) + 1 >= changelog.FOLD:
        with contextlib.suppress(checks.Conflict):  # the next writer will merge
            changelog.compact(spark, path, groups, max_records)
    return _marked(told, failed, groups, "verify failed")


def select_targets(targets: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Enabled targets (tenant, enabled), of these names if given; fails on names that aren't there."""
    enabled = targets.where("enabled")
    if not names:
        return enabled
    wanted = targets.sparkSession.createDataFrame([(n,) for n in names], "tenant string")
    checks.enforce("targets are configured", wanted.join(enabled, "tenant", "left_anti"))
    return enabled.join(wanted.distinct(), "tenant", "left_semi")


def read_version(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """The current rows of a table, checked to be complete; an empty table of the schema if there is none yet."""
    return changelog.read(spark, path, schema)


def write_version(df: DataFrame, path: str, keys: tuple[str, ...], max_records: int = 0, groups: list[str] | None = None) -> int:
    """Replaces the table at path by df: written, verified, then published; rows written. See changelog.write_base()."""
    return changelog.write_base(df, path, keys, groups or [], sinks.current(df.sparkSession, path), max_records)


def sync_table(desired: DataFrame, path: str, keys: tuple[str, ...], limit: float = 0.25, override: bool = False, dry_run: bool = False, max_records: int = 0) -> DataFrame:
    """Brings the table at path to the desired rows; returns the plan, in the order of the keys. dry_run: plan and guard only.

    Fails, with nothing changed, on bad keys or if it would delete more than `limit` of the rows.
    """
    spark, columns = desired.sparkSession, desired.columns
    before = sinks.current(spark, path)
    current = changelog.read(spark, path, desired.schema, before)
    checks.no_other_columns(current.columns, tuple(columns))
    checks.enforce("keys are filled and unique", checks.key_violations(desired, keys))
    wanted = changelog.bucketed(desired, keys)
    want, have = changelog.digests(wanted, columns, []), changelog.stored_digests(spark, path, before, desired.schema, keys, [])
    buckets = _differing(want, have, [])
    there = changelog.read(spark, path, desired.schema, before, buckets, check=False).select(*columns)
    changes = changelog.changed(wanted.where(F.col("_bucket").isin(buckets)).select(*columns), there, keys)
    version, done = f"changes-{uuid.uuid4().hex}", False
    try:
        changelog.save(changes, f"{path}/{version}", keys, max_records)
        written = spark.read.schema(changes.schema).parquet(f"{path}/{version}")
        n = have.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n_current")).first()[0]
        counts = written.agg(F.count_if(F.col("_op") == "cut").alias("n_stale"), F.lit(n).alias("n_current"))
        checks.enforce("deletes are within the limit", checks.delete_guard(counts, limit, override))
        checks.enforce("the written changes are the wanted ones", changelog.wrong(have, written, want, columns, []))
        done = not dry_run and changelog.append(spark, path, version, keys, columns, [], have, before) > 0
    finally:
        if not done:
            sinks.remove(spark, f"{path}/{version}")
    return plan_changes(desired, current.select(*columns), keys).orderBy(*keys)
