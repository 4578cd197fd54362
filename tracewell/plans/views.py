"""Telemetry and indicator tables derived from the test tables, which have no security data of their own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.functions.text import unique_text, url_host


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_of(spark: SparkSession, sf_dir: str) -> Column:
    """The time of the last event; one value goes to the driver."""
    return F.lit(table(spark, sf_dir, "events").agg(F.max("ts").cast("string")).first()[0]).cast("timestamp_ntz")


def _count(df: DataFrame) -> Column:
    return F.lit(df.count())


def loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Driver loads: events that load a document."""
    docs = table(spark, sf_dir, "documents")
    files = docs.select(F.col("doc_id").alias("file_id"), F.sha2("text", 256).alias("sha256"), F.sha1("text").alias("sha1"))
    events = table(spark, sf_dir, "events").withColumn("file_id", F.col("event_id") % _count(docs))
    named = events.join(files, "file_id")
    return named.select("ts", F.col("event_id").alias("report_id"), F.col("user_id").alias("device_id"), F.col("event_type").alias("action"), F.col("file_id").alias("file_name"), "sha1", "sha256")


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a toxic label as driver samples."""
    toxic = table(spark, sf_dir, "labels").where("toxic = 1").select("doc_id").distinct()
    docs = table(spark, sf_dir, "documents").join(toxic, "doc_id", "left_semi")
    return docs.select(F.sha2("text", 256).alias("sha256"), F.sha1("text").alias("sha1"), F.md5("text").alias("md5"), F.col("source").alias("driver_name"), F.col("lang").alias("category"))


def drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets = [unique_text(F.col(c)).alias(c) for c in ("sha1", "md5", "driver_name", "category")]
    return samples(spark, sf_dir).groupBy("sha256").agg(*sets)


def connections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Network events: events that connect to a page's host."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", url_host(F.col("url")).alias("host"))
    events = table(spark, sf_dir, "events").withColumn("page_id", F.col("event_id") % _count(table(spark, sf_dir, "pages")))
    joined = events.join(pages, "page_id")
    path = F.concat(F.lit("/bin/"), F.col("event_type"))
    return joined.select("ts", F.col("event_id").alias("report_id"), F.col("user_id").alias("device_id"), F.col("event_type").alias("action"), "host", F.concat(F.lit("p"), (F.col("user_id") % 3).cast("string")).alias("process"), F.concat(F.lit("u"), (F.col("event_id") % 4).cast("string")).alias("user"), path.alias("path"), F.concat(F.lit("s"), (F.col("event_id") % 3).cast("string")).alias("sub_type"), F.concat(path, F.lit(" -"), (F.col("user_id") % 2).cast("string")).alias("command"))


def domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page hosts without their first service label, and the parents of some, as indicator domains."""
    host = url_host(F.col("url"))
    bare = table(spark, sf_dir, "pages").select(F.regexp_replace(host, r"^(www|m|blog)\.", "").alias("domain")).where("domain IS NOT NULL").distinct()
    parents = bare.where(F.length("domain") % 3 == 0).select(F.substring_index("domain", ".", -2).alias("domain"))
    both = bare.unionByName(parents).distinct()
    return both.select("domain", F.concat(F.lit("tool_"), (F.length("domain") % 7).cast("string")).alias("rmm_tool"), F.concat(F.lit("*."), F.col("domain")).alias("pattern"))


def exclusions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return domains(spark, sf_dir).where(F.length("domain") % 5 == 0).select("domain", F.concat(F.lit("reason "), F.length("domain").cast("string")).alias("reason"))


def allowlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upper-case hosts whose length is a multiple of 4."""
    host = url_host(F.col("url"))
    return table(spark, sf_dir, "pages").select(F.upper(host).alias("host")).where("length(host) % 4 = 0").distinct()


def desired_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as they should be: one in seven isn't there, one in five has another segment."""
    segment = F.when(F.col("c_custkey") % 5 == 0, F.concat(F.lit("NEW "), F.col("c_mktsegment"))).otherwise(F.col("c_mktsegment"))
    return table(spark, sf_dir, "customer").where("c_custkey % 7 <> 0").select(F.col("c_nationkey").alias("tenant"), "c_custkey", "c_name", segment.alias("segment"))


def current_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as they are: one in eleven isn't there yet."""
    return table(spark, sf_dir, "customer").where("c_custkey % 11 <> 0").select(F.col("c_nationkey").alias("tenant"), "c_custkey", "c_name", F.col("c_mktsegment").alias("segment"))


def flawed_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """desired_customers with rows twice in tenant 3 and rows without a key in tenant 5."""
    good = desired_customers(spark, sf_dir)
    return good.unionByName(good.where("tenant = 3 AND c_custkey % 2 = 0")).unionByName(good.where("tenant = 5 AND c_custkey % 3 = 0").withColumn("c_custkey", F.lit(None).cast(good.schema["c_custkey"].dataType)))


#: The same views in DuckDB SQL.
SQL = r"""
as_of AS (SELECT max(ts) AS t FROM events),
loads AS (SELECT e.ts, e.event_id AS report_id, e.user_id AS device_id, e.event_type AS action, d.doc_id AS file_name, sha1(d.text) AS sha1, sha256(d.text) AS sha256
  FROM events e JOIN documents d ON d.doc_id = e.event_id % (SELECT count(*) FROM documents)),
samples AS (SELECT sha256(text) AS sha256, sha1(text) AS sha1, md5(text) AS md5, source AS driver_name, lang AS category
  FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)),
drivers AS (SELECT sha256, string_agg(DISTINCT sha1, ';' ORDER BY sha1) AS sha1, string_agg(DISTINCT md5, ';' ORDER BY md5) AS md5,
  string_agg(DISTINCT driver_name, ';' ORDER BY driver_name) AS driver_name, string_agg(DISTINCT category, ';' ORDER BY category) AS category FROM samples GROUP BY sha256),
hosts AS (SELECT page_id, url, nullif(lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]+)', 1)), '') AS host FROM pages),
connections AS (SELECT e.ts, e.event_id AS report_id, e.user_id AS device_id, e.event_type AS action, h.host, 'p' || (e.user_id % 3) AS process, 'u' || (e.event_id % 4) AS "user", '/bin/' || e.event_type AS path,
  's' || (e.event_id % 3) AS sub_type, '/bin/' || e.event_type || ' -' || (e.user_id % 2) AS command
  FROM events e JOIN hosts h ON h.page_id = e.event_id % (SELECT count(*) FROM pages)),
bare AS (SELECT DISTINCT regexp_replace(host, '^(www|m|blog)\.', '') AS domain FROM hosts WHERE host IS NOT NULL),
all_domains AS (SELECT domain FROM bare UNION SELECT regexp_extract(domain, '([^.]+\.[^.]+)$', 1) FROM bare WHERE length(domain) % 3 = 0),
domains AS (SELECT domain, 'tool_' || (length(domain) % 7) AS rmm_tool, '*.' || domain AS pattern FROM all_domains),
domain_sets AS (SELECT domain, string_agg(DISTINCT rmm_tool, ';' ORDER BY rmm_tool) AS rmm_tools, string_agg(DISTINCT pattern, ';' ORDER BY pattern) AS patterns FROM domains WHERE domain <> '' GROUP BY domain),
exclusions AS (SELECT domain, 'reason ' || length(domain) AS reason FROM domains WHERE length(domain) % 5 = 0),
allowlist AS (SELECT DISTINCT upper(host) AS host FROM hosts WHERE length(host) % 4 = 0),
desired AS (SELECT c_nationkey AS tenant, c_custkey, c_name, CASE WHEN c_custkey % 5 = 0 THEN 'NEW ' || c_mktsegment ELSE c_mktsegment END AS segment FROM customer WHERE c_custkey % 7 <> 0),
current_rows AS (SELECT c_nationkey AS tenant, c_custkey, c_name, c_mktsegment AS segment FROM customer WHERE c_custkey % 11 <> 0),
plan AS (SELECT coalesce(d.c_custkey, c.c_custkey) AS c_custkey, coalesce(d.tenant, c.tenant) AS tenant,
  CASE WHEN c.c_custkey IS NULL THEN 'insert' WHEN d.c_custkey IS NULL THEN 'stale'
       WHEN d.c_name IS NOT DISTINCT FROM c.c_name AND d.segment IS NOT DISTINCT FROM c.segment THEN 'same' ELSE 'update' END AS op, d.c_name, d.segment
  FROM desired d FULL JOIN current_rows c ON d.c_custkey = c.c_custkey AND d.tenant = c.tenant)
"""
