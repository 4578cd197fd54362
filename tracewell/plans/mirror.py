"""Jobs that users run: mirror build, verified load, and the sync of a mirror to all tenants."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tracewell.operators import checks, sinks, sync
from tracewell.sources import feeds, json_arrays
from tracewell.sources.specs import DRIVER_HASHES, RMM_DOMAINS, TableSpec

#: Most bytes of a feed file.
FEED_BYTES = 100 << 20


def build(spark: SparkSession, drivers_json: str, rmm_csv: str, exclusions_csv: str, out: str, sources: dict[str, str] | None = None, split: bool = False) -> DataFrame:
    """Feeds -> indicator tables, raw archive and manifest as the next version under out; returns the counts (name, n).

    Readers see the version before until all of the next one is written. sources: locations for the
    manifest (drivers_url, rmm_url); by default those that are read. A table is counted by the job that writes it. split:
    the driver feed is read by byte ranges.
    """
    for path in (drivers_json, rmm_csv):
        checks.enforce("feeds have a bounded size", checks.size_violations(spark, path, FEED_BYTES))
    before, version = sinks.current(spark, out), f"v-{uuid.uuid4().hex}"
    to = f"{out}/{version}"
    nodes = json_arrays.scan_objects(spark, drivers_json) if split else feeds.scan_json(spark, drivers_json)
    drivers = feeds.driver_hashes(nodes).select(*DRIVER_HASHES.fields)
    upstream = feeds.rmm_domains(feeds.scan_csv(spark, rmm_csv, ("URI", "RMM_Tool"))).select(*RMM_DOMAINS.fields)
    effective, excluded = feeds.split_excluded(upstream, feeds.scan_exclusions(spark, exclusions_csv))
    n = {
        "driver_hashes": sinks.write_csv(drivers, f"{to}/driver_hashes", ["sha256"]),
        "rmm_domains": sinks.write_csv(effective.select(*RMM_DOMAINS.fields), f"{to}/rmm_domains", ["domain", "rmm_tool", "pattern"]),
        "rmm_excluded": sinks.write_csv(excluded, f"{to}/rmm_excluded", ["domain", "rmm_tool", "pattern"]),
    }
    for path in (drivers_json, rmm_csv):
        sinks.archive(spark, path, f"{to}/raw")
    for what, rows in (("driver feed", n["driver_hashes"]), ("RMM feed", n["rmm_domains"] + n["rmm_excluded"])):
        if not rows:
            raise checks.CheckFailed(f"the {what} has no rows")
    counts = {"driver_hash_rows": n["driver_hashes"], "rmm_upstream_rows": n["rmm_domains"] + n["rmm_excluded"], "rmm_excluded_rows": n["rmm_excluded"], "rmm_effective_rows": n["rmm_domains"], "rmm_domain_rows": n["rmm_domains"]}
    hashes = None
    for name, path in (("drivers_sha256", drivers_json), ("rmm_sha256", rmm_csv), ("driver_hashes_sha256", f"{to}/driver_hashes/*.csv"), ("rmm_domains_sha256", f"{to}/rmm_domains/*.csv")):
        row = checks.file_hashes(spark, path).select(F.lit(name).alias("name"), "sha256")
        hashes = row if hashes is None else hashes.unionByName(row)
    sinks.write_manifest(counts, hashes, sources or {"drivers_url": drivers_json, "rmm_url": rmm_csv}, f"{to}/manifest")
    sinks.publish(spark, out, version, sum(counts.values()), before)
    return spark.createDataFrame(sorted(counts.items()), "name string, n long")


def verified_load(spark: SparkSession, out: str, spec: TableSpec, count_key: str, pointer: Row | None = None) -> DataFrame:
    """A table of a mirror's version, by default the current one, after its hash, header, keys and count are checked against the manifest."""
    pointer = pointer or sinks.current(spark, out)
    if pointer is None:
        raise checks.CheckFailed(f"no mirror at {out}")
    at = f"{out}/{pointer.version}"
    manifest = feeds.scan_manifest(spark, f"{at}/manifest")
    files = checks.file_hashes(spark, f"{at}/{spec.name}/*.csv")
    wanted = manifest.where(F.col("key") == f"{spec.name}_sha256").select(F.col("value").alias("sha256"))
    checks.enforce("files have the manifest's hash", files.join(wanted, "sha256", "left_anti"))
    expected = manifest.where(F.col("key") == count_key).select(checks.whole_number(F.col("value")).alias("n"))
    return feeds.scan_table(spark, f"{at}/{spec.name}", spec, expected)


def sync_mirror(spark: SparkSession, out: str, targets: DataFrame, root: str, names: list[str] | None = None, limit: float = 0.25, override: bool = False, max_records: int = 0, dry_run: bool = False) -> DataFrame:
    """A mirror's tables, verified, to every enabled tenant: (dataset, tenant, n_upsert, n_stale, n_current, n_desired, status).

    targets: (tenant, enabled), a short configured list; root/<dataset> holds that table's rows of all tenants. Besides
    the statuses of sync.sync_all(), which are a tenant's own, a dataset that fails its verification has status bad
    source for all tenants, one whose table can't be read or written has failed; the others go on. max_records: rows of a file at most, 0 for no such limit.
    """
    tenants = sorted(r.tenant for r in sync.select_targets(targets, names).select("tenant").collect())
    schema = "dataset string, tenant string, n_upsert long, n_stale long, n_current long, n_desired long, status string"
    told = spark.createDataFrame([], schema)
    for spec, key in ((DRIVER_HASHES, "driver_hash_rows"), (RMM_DOMAINS, "rmm_effective_rows")):
        status = "bad source"
        try:
            table = verified_load(spark, out, spec, key)
            status = "failed"
            desired = table.select(F.explode(F.array(*map(F.lit, tenants))).alias("tenant"), *spec.fields)
            report = sync.sync_all(desired, f"{root}/{spec.name}", ["tenant"], ("tenant", *spec.keys), limit, override, max_records, dry_run)
            told = told.unionByName(report.select(F.lit(spec.name).alias("dataset"), "*"))
        except (checks.CheckFailed, AnalysisException, Py4JJavaError):
            told = told.unionByName(spark.createDataFrame([(spec.name, t, 0, 0, 0, 0, status) for t in tenants], schema))
    return told.orderBy("dataset", "tenant")
