"""The four hunting queries as DataFrame plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.functions.text import not_empty, value_set
from tracewell.operators.matching import contains_pairs, hash_match, latest_row, match_either, not_allowed, suffix_pairs
from tracewell.sources.telemetry import lookback


def domain_sets(domains: DataFrame) -> DataFrame:
    """Per domain the sorted sets of its tools and patterns; blank domains are left out."""
    return domains.where(not_empty(F.col("domain"))).groupBy("domain").agg(value_set(F.col("rmm_tool")).alias("rmm_tools"), value_set(F.col("pattern")).alias("patterns"))


def detect_driver_loads(loads: DataFrame, drivers: DataFrame, as_of: Column, interval: str = "4 HOURS", action: str = "DriverLoad", split_multi: bool = False, thin: bool = False) -> DataFrame:
    """Loads of known drivers, by SHA-256 or SHA-1: per device, file and hashes the latest match with first_seen and event_count (matches).

    thin: for indicators too large to broadcast. loads: ts, report_id, device_id, action, file_name, sha1, sha256, ... ; drivers: as DRIVER_HASHES.
    """
    recent = lookback(loads, "ts", as_of, interval).where(F.col("action") == action)
    names = {"sha256": "sha256", "sha1": "sha1"}
    matches = match_either(recent, drivers, names, split_multi, thin=thin)
    return latest_row(matches, ["device_id", "file_name", "sha1", "sha256"], "ts", "report_id")


def report_rmm_suffix(connections: DataFrame, domains: DataFrame, allowlist: DataFrame, as_of: Column, interval: str = "7 DAYS", action: str = "ConnectionSuccess") -> DataFrame:
    """Connections to known domains or their subdomains: per device, host, domain and process the latest one, with the domain's tools and patterns.

    Hosts are matched once each, not once a connection. connections: ts, report_id, device_id, action, host, process, ...
    """
    recent = lookback(connections, "ts", as_of, interval).where((F.col("action") == action) & not_empty(F.col("host")))
    known = domain_sets(domains)
    pairs = not_allowed(suffix_pairs(recent, known), allowlist)
    matched = recent.join(pairs, "host")
    return latest_row(matched, ["device_id", "host", "domain", "process"], "ts", "report_id").join(known, "domain", "left")


def detect_module_loads(events: DataFrame, drivers: DataFrame, as_of: Column, interval: str = "1 HOUR") -> DataFrame:
    """Module loads whose SHA-256, in any case, is a known driver's, one row a match, with the driver's columns."""
    recent = lookback(events, "ts", as_of, interval).where(F.col("sha256").isNotNull())
    return hash_match(recent, drivers, "sha256", "sha256")


def report_rmm_contains(connections: DataFrame, domains: DataFrame, as_of: Column, interval: str = "7 DAYS", allowlist: DataFrame | None = None) -> DataFrame:
    """Connections summarised per device, host and process, for hosts that are or contain a known domain, with its tools and patterns and five sets of values."""
    recent = lookback(connections, "ts", as_of, interval).where(F.col("host").isNotNull()).withColumn("host", F.lower("host"))
    if allowlist is not None:
        recent = not_allowed(recent, allowlist)
    sets = [value_set(F.col(c)).alias(f"{c}s") for c in ("user", "action", "sub_type", "path", "command")]
    hosts = recent.groupBy("device_id", "host", "process").agg(F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"), F.count(F.lit(1)).alias("event_count"), *sets)
    known = domain_sets(domains)
    return hosts.join(contains_pairs(hosts, known), "host").join(known, "domain")
