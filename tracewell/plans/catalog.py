"""Registered queries of the indicator operators, with their DuckDB oracles, over the views of views.py."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.functions import text as T
from tracewell.operators import checks, matching, sinks, sync
from tracewell.operators.shared import shared_dir
from tracewell.plans import detections, views
from tracewell.sources import feeds, json_arrays, telemetry

FLAGSHIP = "report_rmm_suffix"
QUERIES = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its name, with the SQL that follows the views."""

    def put(f):
        QUERIES[f.__name__] = f
        if sql:  # a statement that begins with a comma goes on with more views
            ORACLES[f.__name__] = f"WITH {views.SQL.strip()}\n{sql.strip()}"
        return f

    return put


def _joined(*columns: str) -> list:
    return [F.array_join(c, ";").alias(c) for c in columns]


@query("SELECT event_id, ts, user_id FROM events WHERE ts > (SELECT t FROM as_of) - INTERVAL 7 DAY AND event_type = 'error'")
def lookback_filter(spark: SparkSession, d: str) -> DataFrame:
    recent = detections.lookback(views.table(spark, d, "events"), "ts", views.as_of(spark, d), "7 DAYS")
    return recent.where("event_type = 'error'").select("event_id", "ts", "user_id")


@query("SELECT event_id, ts, user_id FROM events WHERE ts > (SELECT t FROM as_of) - INTERVAL 4 HOUR")
def pruned_lookback(spark: SparkSession, d: str) -> DataFrame:
    """The events as a table by dates, of which a lookback from the last one's time, found as the query runs, reads its own days."""
    path = f"{shared_dir(spark)}/tracewell/events-{uuid.uuid4().hex}"
    telemetry.append(views.table(spark, d, "events"), path)
    last = views.table(spark, d, "events").agg(F.max("ts")).scalar()
    return telemetry.lookback(telemetry.read(spark, path), "ts", last, "4 HOURS").select("event_id", "ts", "user_id")


@query("SELECT page_id, host, regexp_replace(regexp_replace(regexp_replace(lower(url), '^[a-z][a-z0-9+.-]*://', ''), '/.*$', ''), ':[0-9]+$', '') AS stripped FROM hosts")
def url_host(spark: SparkSession, d: str) -> DataFrame:
    return views.table(spark, d, "pages").select("page_id", T.url_host(F.col("url")).alias("host"), T.strip_host(F.col("url")).alias("stripped"))


@query("SELECT doc_id, sha256(text) AS good, CASE WHEN doc_id % 3 = 0 THEN '' ELSE md5(text) END AS md5 FROM documents")
def clean_hash(spark: SparkSession, d: str) -> DataFrame:
    docs = views.table(spark, d, "documents")
    padded = F.concat(F.lit(" \t"), F.upper(F.sha2("text", 256)), F.lit("　\n"))
    cut = F.when(F.col("doc_id") % 3 == 0, F.concat(F.md5("text"), F.lit("0"))).otherwise(F.md5("text"))
    return docs.select("doc_id", T.valid_hash(padded, 64).alias("good"), T.valid_hash(cut, 32).alias("md5"))


PATTERN = "CASE page_id % 6 WHEN 0 THEN '*.' || host WHEN 1 THEN host WHEN 2 THEN 'relay-[a-f0-9]{8}.' || host || ':443' WHEN 3 THEN 'x*.' || host || '.' WHEN 4 THEN 'a+' || host || '/p' ELSE '{b' || host END"


@query(f"""
SELECT page_id, CASE WHEN page_id % 6 = 2 OR page_id % 6 = 3 OR page_id % 6 = 5 THEN regexp_extract(host, '([^.]+\\.[^.]+)$', 1)
  WHEN page_id % 6 = 4 THEN 'a+' || host ELSE host END AS domain FROM hosts WHERE host IS NOT NULL""")
def domain_root(spark: SparkSession, d: str) -> DataFrame:
    hosts = views.table(spark, d, "pages").select("page_id", T.url_host(F.col("url")).alias("host")).where("host IS NOT NULL")
    return hosts.select("page_id", T.domain_root(F.expr(PATTERN)).alias("domain"))


@query("""
SELECT page_id, '^(?:' || CASE page_id % 6 WHEN 0 THEN '.*\\.' WHEN 1 THEN '' WHEN 2 THEN 'relay-[a-f0-9]{8}\\.' WHEN 3 THEN 'x.*\\.' WHEN 4 THEN 'a\\+' ELSE '\\{b' END || replace(host, '.', '\\.') || ')$' AS regex
FROM hosts WHERE host IS NOT NULL""")
def glob_regex(spark: SparkSession, d: str) -> DataFrame:
    hosts = views.table(spark, d, "pages").select("page_id", T.url_host(F.col("url")).alias("host")).where("host IS NOT NULL")
    return hosts.select("page_id", T.glob_regex(F.expr(PATTERN)).alias("regex"))


@query("SELECT lang, string_agg(DISTINCT source, ';' ORDER BY source) AS sources FROM documents WHERE source <> '' GROUP BY lang")
def unique_text(spark: SparkSession, d: str) -> DataFrame:
    return views.table(spark, d, "documents").groupBy("lang").agg(T.unique_text(F.col("source")).alias("sources"))


@query("SELECT sha256, sha1, md5, driver_name, category FROM drivers")
def hash_table_build(spark: SparkSession, d: str) -> DataFrame:
    raw = views.samples(spark, d).select(*(F.upper(c).alias(c) for c in ("sha256", "sha1", "md5")), "driver_name", "category")
    nothing = F.lit(None).cast("string")
    rows = raw.select(*(T.valid_hash(F.col(c), n).alias(c) for c, n in (("sha256", 64), ("sha1", 40), ("md5", 32))), "driver_name", "category", nothing.alias("verified"), nothing.alias("source_id"), nothing.alias("created"))
    return feeds.group_hashes(rows).select("sha256", "sha1", "md5", "driver_name", "category")


@query("SELECT sha256, sha1, driver_name FROM drivers")
def driver_feed(spark: SparkSession, d: str) -> DataFrame:
    """The samples as nested feed objects, read back as variants and grouped."""
    sample = F.to_json(F.struct(F.struct(F.lit("x").alias("other")).alias("Ignored"), F.array("driver_name").alias("Tags"), F.col("category").alias("Category"), F.array(F.struct(F.upper("sha256").alias("SHA256"), F.col("sha1").alias("SHA1"), F.lit("bad").alias("MD5"))).alias("KnownVulnerableSamples")))
    nodes = views.samples(spark, d).select(F.parse_json(sample).alias("node"))
    return feeds.driver_hashes(nodes).select("sha256", "sha1", "driver_name")


@query("SELECT doc_id, lang, text FROM documents")
def json_array_elements(spark: SparkSession, d: str) -> DataFrame:
    """The documents as JSON arrays of some hundred each, a file an array, read back by byte ranges."""
    path = f"{shared_dir(spark)}/tracewell/array-{uuid.uuid4().hex}"
    arrays = views.table(spark, d, "documents").groupBy(F.floor(F.col("doc_id") / 200)).agg(F.to_json(F.collect_list(F.struct("doc_id", "lang", "text"))).alias("value"))
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return json_arrays.scan_objects(spark, path).select(*(F.variant_get("node", f"$.{c}", t).alias(c) for c, t in (("doc_id", "long"), ("lang", "string"), ("text", "string"))))


@query("SELECT DISTINCT lower(host) AS domain, lower(host) AS pattern, 'tool_' || (length(host) % 3) AS rmm_tool, '^(?:' || replace(lower(host), '.', '\\.') || ')$' AS regex FROM hosts WHERE host IS NOT NULL")
def dedup_last(spark: SparkSession, d: str) -> DataFrame:
    host = T.url_host(F.col("url"))
    cased = F.when(F.col("page_id") % 2 == 0, F.upper(host)).otherwise(host)
    feed = views.table(spark, d, "pages").select(cased.alias("URI"), F.concat(F.lit("tool_"), (F.length(host) % 3).cast("string")).alias("RMM_Tool"))
    return feeds.rmm_domains(feed)


@query("SELECT domain, rmm_tool, pattern FROM domains WHERE domain NOT IN (SELECT domain FROM exclusions)")
def exclusion_effective(spark: SparkSession, d: str) -> DataFrame:
    return feeds.split_excluded(views.domains(spark, d), views.exclusions(spark, d))[0]


@query("SELECT domain, rmm_tool, pattern, reason AS exclusion_reason FROM domains JOIN exclusions USING (domain)")
def exclusion_excluded(spark: SparkSession, d: str) -> DataFrame:
    return feeds.split_excluded(views.domains(spark, d), views.exclusions(spark, d))[1]


@query("SELECT report_id, host FROM connections WHERE host IS NULL OR lower(host) NOT IN (SELECT lower(host) FROM allowlist)")
def allowlist_anti(spark: SparkSession, d: str) -> DataFrame:
    return matching.not_allowed(views.connections(spark, d), views.allowlist(spark, d)).select("report_id", "host")


@query("SELECT report_id, l.sha256, driver_name FROM loads l JOIN drivers USING (sha256)")
def hash_join_sha256(spark: SparkSession, d: str) -> DataFrame:
    loads = views.loads(spark, d).withColumn("sha256", F.upper("sha256"))
    return matching.hash_match(loads, views.drivers(spark, d), "sha256", "sha256").select("report_id", F.lower("sha256").alias("sha256"), "driver_name")


@query("SELECT report_id, l.sha1, driver_name FROM loads l JOIN drivers d ON l.sha1 = d.sha1")
def hash_join_sha1(spark: SparkSession, d: str) -> DataFrame:
    return matching.hash_match(views.loads(spark, d), views.drivers(spark, d), "sha1", "sha1").select("report_id", "sha1", "driver_name")


@query("SELECT DISTINCT report_id, l.sha256, driver_name FROM (SELECT l.*, d.driver_name FROM loads l JOIN drivers d USING (sha256) UNION ALL SELECT l.*, d.driver_name FROM loads l JOIN drivers d ON l.sha1 = d.sha1) l")
def hash_match_either(spark: SparkSession, d: str) -> DataFrame:
    return matching.match_either(views.loads(spark, d), views.drivers(spark, d), {"sha256": "sha256", "sha1": "sha1"}).select("report_id", "sha256", "driver_name")


@query("SELECT DISTINCT report_id, l.sha256, driver_name FROM (SELECT l.*, d.driver_name FROM loads l JOIN drivers d USING (sha256) UNION ALL SELECT l.*, d.driver_name FROM loads l JOIN drivers d ON l.sha1 = d.sha1) l")
def hash_match_thinned(spark: SparkSession, d: str) -> DataFrame:
    """hash_match_either for indicators too large to broadcast."""
    return matching.match_either(views.loads(spark, d), views.drivers(spark, d), {"sha256": "sha256", "sha1": "sha1"}, thin=True).select("report_id", "sha256", "driver_name")


@query("SELECT c.c_custkey, c.c_nationkey, c.c_name, n.n_name FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey")
def join_keep_left(spark: SparkSession, d: str) -> DataFrame:
    nations = views.table(spark, d, "nation").withColumn("c_name", F.lit("clash"))
    return matching.join_keep_left(views.table(spark, d, "customer"), nations, "c_nationkey", "n_nationkey").select("c_custkey", "c_nationkey", "c_name", "n_name")


@query("SELECT DISTINCT h.host, d.domain FROM hosts h JOIN domains d ON h.host = d.domain OR ends_with(h.host, '.' || d.domain)")
def suffix_match(spark: SparkSession, d: str) -> DataFrame:
    return matching.suffix_pairs(views.connections(spark, d), views.domains(spark, d))


@query("SELECT DISTINCT h.host, d.domain FROM hosts h JOIN domains d ON h.host = d.domain OR contains(h.host, '.' || d.domain)")
def contains_match(spark: SparkSession, d: str) -> DataFrame:
    return matching.contains_pairs(views.connections(spark, d), views.domains(spark, d))


@query("SELECT user_id, event_type, arg_max(event_id, ts) AS event_id, arg_max(value, ts) AS value, min(ts) AS first_seen, max(ts) AS last_seen, count(*) AS event_count FROM events GROUP BY user_id, event_type")
def latest_row(spark: SparkSession, d: str) -> DataFrame:
    return matching.latest_row(views.table(spark, d, "events").drop("props"), ["user_id", "event_type"], "ts", "event_id").drop("ts")


@query("SELECT host, min(ts) AS first_seen, max(ts) AS last_seen, count(*) AS event_count, string_agg(DISTINCT \"user\", ';' ORDER BY \"user\") AS users, string_agg(DISTINCT action, ';' ORDER BY action) AS actions FROM connections WHERE host IS NOT NULL GROUP BY host")
def value_sets(spark: SparkSession, d: str) -> DataFrame:
    rows = views.connections(spark, d).where("host IS NOT NULL").groupBy("host")
    sets = rows.agg(F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"), F.count(F.lit(1)).alias("event_count"), T.value_set(F.col("user")).alias("users"), T.value_set(F.col("action")).alias("actions"))
    return sets.select("host", "first_seen", "last_seen", "event_count", *_joined("users", "actions"))


@query("""
, matches AS (SELECT DISTINCT * FROM (
  SELECT l.*, d.driver_name, d.category FROM loads l JOIN drivers d ON l.sha256 = d.sha256 WHERE ts > (SELECT t FROM as_of) - INTERVAL 7 DAY AND action = 'error'
  UNION ALL SELECT l.*, d.driver_name, d.category FROM loads l JOIN drivers d ON l.sha1 = d.sha1 WHERE ts > (SELECT t FROM as_of) - INTERVAL 7 DAY AND action = 'error'))
SELECT device_id, file_name, sha1, sha256, arg_max(report_id, ts) AS report_id, arg_max(driver_name, ts) AS driver_name, arg_max(category, ts) AS category, min(ts) AS first_seen, max(ts) AS last_seen, count(*) AS event_count
FROM matches GROUP BY device_id, file_name, sha1, sha256""")
def detect_driver_loads(spark: SparkSession, d: str) -> DataFrame:
    found = detections.detect_driver_loads(views.loads(spark, d), views.drivers(spark, d).drop("md5"), views.as_of(spark, d), "7 DAYS", action="error")
    return found.select("device_id", "file_name", "sha1", "sha256", "report_id", "driver_name", "category", "first_seen", "last_seen", "event_count").orderBy(F.desc("last_seen"))


@query("""
, matches AS (SELECT c.*, d.domain FROM connections c JOIN domain_sets d ON c.host = d.domain OR ends_with(c.host, '.' || d.domain)
  WHERE ts > (SELECT t FROM as_of) - INTERVAL 7 DAY AND action = 'click' AND lower(c.host) NOT IN (SELECT lower(host) FROM allowlist)),
latest AS (SELECT device_id, host, domain, process, arg_max(report_id, ts) AS report_id, min(ts) AS first_seen, max(ts) AS last_seen, count(*) AS event_count FROM matches GROUP BY device_id, host, domain, process)
SELECT l.*, s.rmm_tools, s.patterns FROM latest l LEFT JOIN domain_sets s USING (domain)""")
def report_rmm_suffix(spark: SparkSession, d: str) -> DataFrame:
    found = detections.report_rmm_suffix(views.connections(spark, d), views.domains(spark, d), views.allowlist(spark, d), views.as_of(spark, d), action="click")
    return found.select("device_id", "host", "domain", "process", "report_id", "first_seen", "last_seen", "event_count", *_joined("rmm_tools", "patterns")).orderBy(F.desc("last_seen"))


@query("SELECT l.ts, l.report_id, l.device_id, l.action, l.sha256, d.driver_name, d.category FROM loads l JOIN drivers d ON l.sha256 = d.sha256 WHERE ts > (SELECT t FROM as_of) - INTERVAL 1 DAY")
def detect_module_loads(spark: SparkSession, d: str) -> DataFrame:
    found = detections.detect_module_loads(views.loads(spark, d), views.drivers(spark, d), views.as_of(spark, d), "1 DAY")
    return found.select("ts", "report_id", "device_id", "action", "sha256", "driver_name", "category")


@query("""
, grouped AS (SELECT device_id, host, process, min(ts) AS first_seen, max(ts) AS last_seen, count(*) AS event_count, string_agg(DISTINCT "user", ';' ORDER BY "user") AS users, string_agg(DISTINCT action, ';' ORDER BY action) AS actions, string_agg(DISTINCT path, ';' ORDER BY path) AS paths,
  string_agg(DISTINCT sub_type, ';' ORDER BY sub_type) AS sub_types, string_agg(DISTINCT command, ';' ORDER BY command) AS commands
  FROM connections WHERE ts > (SELECT t FROM as_of) - INTERVAL 7 DAY AND host IS NOT NULL GROUP BY device_id, host, process)
SELECT g.*, s.domain, s.rmm_tools, s.patterns FROM grouped g JOIN domain_sets s ON g.host = s.domain OR contains(g.host, '.' || s.domain)""")
def report_rmm_contains(spark: SparkSession, d: str) -> DataFrame:
    found = detections.report_rmm_contains(views.connections(spark, d), views.domains(spark, d), views.as_of(spark, d))
    return found.select("device_id", "host", "process", "first_seen", "last_seen", "event_count", "domain", *_joined("users", "actions", "sub_types", "paths", "commands", "rmm_tools", "patterns"))


KEYS = ("tenant", "c_custkey")


def _plan(spark: SparkSession, d: str) -> DataFrame:
    return sync.plan_changes(views.desired_customers(spark, d), views.current_customers(spark, d), KEYS)


@query("SELECT tenant, c_custkey, op, c_name, segment FROM plan")
def plan_changes(spark: SparkSession, d: str) -> DataFrame:
    return _plan(spark, d).select("tenant", "c_custkey", "op", "new.c_name", "new.segment")


@query("SELECT tenant, c_custkey, c_name, segment FROM desired")
def apply_changes(spark: SparkSession, d: str) -> DataFrame:
    return sync.apply_changes(_plan(spark, d), KEYS)


@query("SELECT count(*) FILTER (op = 'insert') AS missing, count(*) FILTER (op = 'stale') AS extra, count(*) FILTER (op = 'update') AS changed FROM plan")
def verify_diff(spark: SparkSession, d: str) -> DataFrame:
    return sync.verify_diff(views.current_customers(spark, d), views.desired_customers(spark, d), KEYS)


COUNTS = """
, counts AS (SELECT tenant, count(*) FILTER (op IN ('insert', 'update')) AS n_upsert, count(*) FILTER (op = 'stale') AS n_stale,
  count(*) FILTER (op <> 'insert') AS n_current, count(*) FILTER (op <> 'stale') AS n_desired FROM plan GROUP BY tenant)"""


@query(COUNTS + " SELECT tenant, n_stale, n_current FROM counts WHERE n_stale > 0 AND n_current > 0 AND n_stale::DOUBLE / n_current > 0.15")
def delete_guard(spark: SparkSession, d: str) -> DataFrame:
    return checks.delete_guard(sync.change_counts(_plan(spark, d), ["tenant"]), 0.15).select("tenant", "n_stale", "n_current")


@query(COUNTS + " SELECT *, CASE WHEN n_stale > 0 AND n_current > 0 AND n_stale::DOUBLE / n_current > 0.15 THEN 'guarded' ELSE 'ok' END AS status FROM counts")
def tenant_sync_report(spark: SparkSession, d: str) -> DataFrame:
    return sync.tenant_report(_plan(spark, d), ["tenant"], 0.15)


@query(COUNTS + """, passed AS (SELECT tenant FROM counts WHERE NOT (n_stale > 0 AND n_current > 0 AND n_stale::DOUBLE / n_current > 0.15))
SELECT tenant, c_custkey, c_name, segment FROM desired WHERE tenant IN (SELECT tenant FROM passed)
UNION ALL SELECT tenant, c_custkey, c_name, segment FROM current_rows WHERE tenant NOT IN (SELECT tenant FROM passed)""")
def sync_tenants(spark: SparkSession, d: str) -> DataFrame:
    return sync.sync_tenants(views.desired_customers(spark, d), views.current_customers(spark, d), ["tenant"], KEYS, 0.15)[0]


@query("""
, flawed AS (SELECT * FROM desired UNION ALL SELECT * FROM desired WHERE tenant = 3 AND c_custkey % 2 = 0
  UNION ALL SELECT tenant, NULL, c_name, segment FROM desired WHERE tenant = 5 AND c_custkey % 3 = 0),
bad AS (SELECT DISTINCT tenant FROM (SELECT tenant, c_custkey FROM flawed GROUP BY ALL HAVING count(*) > 1 OR c_custkey IS NULL)),
counts AS (SELECT tenant, count(*) FILTER (op IN ('insert', 'update')) AS n_upsert, count(*) FILTER (op = 'stale') AS n_stale,
  count(*) FILTER (op <> 'insert') AS n_current, count(*) FILTER (op <> 'stale') AS n_desired FROM plan GROUP BY tenant)
SELECT tenant, CASE WHEN b.tenant IS NULL THEN n_upsert ELSE 0 END AS n_upsert, CASE WHEN b.tenant IS NULL THEN n_stale ELSE 0 END AS n_stale, n_current,
  CASE WHEN b.tenant IS NULL THEN n_desired ELSE (SELECT count(*) FROM flawed f WHERE f.tenant = c.tenant) END AS n_desired,
  CASE WHEN b.tenant IS NOT NULL THEN 'bad keys' WHEN n_stale > 0 AND n_current > 0 AND n_stale::DOUBLE / n_current > 0.15 THEN 'guarded' ELSE 'ok' END AS status
FROM counts c LEFT JOIN bad b USING (tenant)""")
def sync_report(spark: SparkSession, d: str) -> DataFrame:
    return sync.sync_tenants(views.flawed_customers(spark, d), views.current_customers(spark, d), ["tenant"], KEYS, 0.15)[1]


def _synced(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(report, rows) of a table on disk that has the current customers and is brought to the flawed ones by a writer that loses rows of tenant 4."""
    path = f"{shared_dir(spark)}/tracewell/customers-{uuid.uuid4().hex}"
    sync.sync_all(views.current_customers(spark, d), path, ["tenant"], KEYS)
    loses = lambda rows, folder: rows.where("tenant <> 4 OR c_custkey % 2 = 0").write.parquet(folder)
    report = sync.sync_all(views.flawed_customers(spark, d), path, ["tenant"], KEYS, 0.15, write=loses)
    return report, sync.read_version(spark, path)


SYNCED = """
, flawed AS (SELECT * FROM desired UNION ALL SELECT * FROM desired WHERE tenant = 3 AND c_custkey % 2 = 0
  UNION ALL SELECT tenant, NULL, c_name, segment FROM desired WHERE tenant = 5 AND c_custkey % 3 = 0),
bad AS (SELECT DISTINCT tenant FROM (SELECT tenant, c_custkey FROM flawed GROUP BY ALL HAVING count(*) > 1 OR c_custkey IS NULL)),
lost AS (SELECT DISTINCT tenant FROM plan WHERE tenant = 4 AND c_custkey % 2 = 1 AND op <> 'same'),
counts AS (SELECT tenant, count(*) FILTER (op IN ('insert', 'update')) AS n_upsert, count(*) FILTER (op = 'stale') AS n_stale,
  count(*) FILTER (op <> 'insert') AS n_current, count(*) FILTER (op <> 'stale') AS n_desired FROM plan GROUP BY tenant),
told AS (SELECT tenant, CASE WHEN b.tenant IS NULL THEN n_upsert ELSE 0 END AS n_upsert, CASE WHEN b.tenant IS NULL THEN n_stale ELSE 0 END AS n_stale, n_current,
  CASE WHEN b.tenant IS NULL THEN n_desired ELSE (SELECT count(*) FROM flawed f WHERE f.tenant = c.tenant) END AS n_desired,
  CASE WHEN b.tenant IS NOT NULL THEN 'bad keys' WHEN n_stale > 0 AND n_current > 0 AND n_stale::DOUBLE / n_current > 0.15 THEN 'guarded' WHEN l.tenant IS NOT NULL THEN 'verify failed' ELSE 'ok' END AS status
  FROM counts c LEFT JOIN bad b USING (tenant) LEFT JOIN lost l USING (tenant))"""


@query(SYNCED + " SELECT * FROM told WHERE tenant IN (SELECT tenant FROM flawed)")
def sync_log_report(spark: SparkSession, d: str) -> DataFrame:
    return _synced(spark, d)[0]


@query(SYNCED + """
SELECT tenant, c_custkey, c_name, segment FROM desired WHERE tenant IN (SELECT tenant FROM told WHERE status = 'ok')
UNION ALL SELECT tenant, c_custkey, c_name, segment FROM current_rows WHERE tenant NOT IN (SELECT tenant FROM told WHERE status = 'ok')""")
def sync_log_rows(spark: SparkSession, d: str) -> DataFrame:
    return _synced(spark, d)[1]


@query("SELECT tenant, c_custkey, op FROM plan WHERE op <> 'same'")
def reconcile_buckets(spark: SparkSession, d: str) -> DataFrame:
    return sync.reconcile(views.desired_customers(spark, d), views.current_customers(spark, d), KEYS, ["tenant"]).select("tenant", "c_custkey", "op")


@query("SELECT c_nationkey AS tenant, c_mktsegment AS segment, count(*) AS n, 'duplicate key' AS violation FROM customer GROUP BY ALL HAVING count(*) > 1")
def key_violations(spark: SparkSession, d: str) -> DataFrame:
    rows = views.table(spark, d, "customer").select(F.col("c_nationkey").alias("tenant"), F.col("c_mktsegment").alias("segment"))
    return checks.key_violations(rows, ("tenant", "segment"))


@query("SELECT 'documents' AS name, count(*) AS n FROM documents UNION ALL SELECT 'pages', count(*) FROM pages UNION ALL SELECT 'events', count(*) FROM events UNION ALL SELECT 'domains', count(*) FROM domains")
def manifest_counts(spark: SparkSession, d: str) -> DataFrame:
    return sinks.manifest_counts({**{n: views.table(spark, d, n) for n in ("documents", "pages", "events")}, "domains": views.domains(spark, d)})


@query("SELECT '*' || domain AS pattern, domain FROM domains WHERE domain LIKE '%.%'")
def broad_domains(spark: SparkSession, d: str) -> DataFrame:
    rows = views.domains(spark, d).select("domain", F.concat(F.lit("*"), F.col("domain")).alias("pattern")).where(F.contains("domain", F.lit(".")))
    return feeds.broad_domains(rows)
