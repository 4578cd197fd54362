"""The detections as Structured Streaming jobs, on the same operators as in batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tracewell.functions.text import not_empty, value_set
from tracewell.operators import checks, sinks
from tracewell.operators.matching import hash_match, label_suffixes, match_contained, match_either, not_allowed
from tracewell.plans import mirror
from tracewell.plans.detections import domain_sets
from tracewell.sources.specs import DRIVER_HASHES


def _timed(events: DataFrame, late: str) -> DataFrame:
    """Events with a watermark, which needs a timestamp with time zone."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)


def module_load_alerts(events: DataFrame, drivers: DataFrame, late: str = "1 HOUR") -> DataFrame:
    """One alert for each load of a known driver: a join with the static indicators, repeated reports dropped within the watermark.

    events: ts, report_id, sha256, ...; for append mode.
    """
    return hash_match(_timed(events, late), drivers, "sha256", "sha256").dropDuplicatesWithinWatermark(["report_id", "sha256"])


def rmm_report(
    connections: DataFrame, domains: DataFrame, allowlist: DataFrame | None = None, action: str = "ConnectionSuccess",
    late: str = "1 HOUR", window: str = "7 DAYS", slide: str = "1 DAY",
) -> DataFrame:
    """detections.report_rmm_suffix() for each window: per device, host, domain and process the latest connection, with first_seen,
    last_seen and event_count, and the domain's tools and patterns.

    Each streamed host is matched by its own label suffixes, so hosts needn't be known before. Hosts of the
    allowlist are left out. Of a group the state holds the least and the latest time, the number and the latest row, not
    its rows. Events beyond the watermark are dropped, and a window comes out (append) once the watermark has passed it.
    connections: ts, report_id, device_id, action, host, process, ...
    """
    keys = ["device_id", "host", "domain", "process"]
    rest = [c for c in connections.columns if c not in keys and c != "ts"]
    seen = _timed(connections, late).where((F.col("action") == action) & not_empty(F.col("host")))
    if allowlist is not None:
        seen = not_allowed(seen, allowlist)
    known = domain_sets(domains)
    matched = seen.withColumn("domain", F.explode(label_suffixes(F.col("host")))).join(known.select("domain"), "domain")
    latest = F.max_by(F.struct(*rest), F.struct("ts", "report_id")).alias("_latest")
    grouped = matched.groupBy(F.window("ts", window, slide).alias("_window"), *keys)
    groups = grouped.agg(F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"), F.count(F.lit(1)).alias("event_count"), latest)
    told = groups.select(F.col("_window.start").alias("window_start"), F.col("_window.end").alias("window_end"), *keys, *(F.col(f"_latest.{c}").alias(c) for c in rest), "first_seen", "last_seen", "event_count")
    return told.join(known, "domain", "left")


def rmm_summary(
    connections: DataFrame, domains: DataFrame, allowlist: DataFrame | None = None,
    late: str = "1 HOUR", window: str = "7 DAYS", slide: str = "1 DAY",
) -> DataFrame:
    """detections.report_rmm_contains() for each window: connections per device, host and process with five sets of values, for hosts that are or contain a known domain.

    Only connections that match go into the state, for each of their domains.
    """
    seen = _timed(connections, late).where(not_empty(F.col("host"))).withColumn("host", F.lower("host"))
    if allowlist is not None:
        seen = not_allowed(seen, allowlist)
    known = domain_sets(domains)
    keys = ["device_id", "host", "process", "domain"]
    sets = [value_set(F.col(c)).alias(f"{c}s") for c in ("user", "action", "sub_type", "path", "command")]
    grouped = match_contained(seen, known).groupBy(F.window("ts", window, slide).alias("_window"), *keys)
    groups = grouped.agg(F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"), F.count(F.lit(1)).alias("event_count"), *sets)
    told = groups.select(F.col("_window.start").alias("window_start"), F.col("_window.end").alias("window_end"), *(c for c in groups.columns if c != "_window"))
    return told.join(known, "domain", "left")


def driver_load_alerts(loads: DataFrame, mirror_out: str, out: str, checkpoint: str, action: str = "DriverLoad", late: str = "1 HOUR", split_multi: bool = False) -> DataStreamWriter:
    """A job that matches loads, by SHA-256 or SHA-1, with the indicators that are current as each batch begins; start() runs it.

    Every batch reads the mirror's pointer, and a new version is verified before it is used. A batch's alerts are
    the folder out/batch=<its number>, which a batch that runs again replaces, so that each comes once; a load
    that is reported again within the watermark isn't matched again. loads: ts, report_id, device_id, action, sha1, sha256, ...
    """
    known: dict = {}

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        pointer = sinks.current(spark, mirror_out)
        if pointer is None:
            raise checks.CheckFailed(f"no mirror at {mirror_out}")
        if known.get("seq") != pointer.seq:
            known.update(seq=pointer.seq, drivers=mirror.verified_load(spark, mirror_out, DRIVER_HASHES, "driver_hash_rows", pointer))
        alerts = match_either(batch, known["drivers"], {"sha256": "sha256", "sha1": "sha1"}, split_multi)
        alerts.withColumn("indicators", F.lit(pointer.seq)).write.mode("overwrite").parquet(f"{out}/batch={number}")

    seen = _timed(loads, late).where(F.col("action") == action).dropDuplicatesWithinWatermark(["report_id", "device_id", "sha1", "sha256"])
    return seen.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
