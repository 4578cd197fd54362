"""Scans of feeds and tables, and the two jobs that turn feeds into indicator tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.functions.text import blank, clean, domain_root, glob_regex, strip_host, unique_text, valid_hash
from tracewell.operators import checks
from tracewell.sources.specs import TableSpec


def scan_json(spark: SparkSession, path: str) -> DataFrame:
    """(node): the objects in a JSON array file, as variants; other elements are left out. Fails if the root is no array.

    The file is one record of one task; json_arrays.scan_objects() reads large ones by byte ranges.
    """
    root = spark.read.format("json").option("singleVariantColumn", "v").option("multiLine", True).load(path)
    checks.enforce("feed root is an array", root.where(~F.coalesce(F.schema_of_variant("v").startswith("ARRAY"), F.lit(False))))
    nodes = root.lateralJoin(spark.tvf.variant_explode(F.col("v").outer())).select(F.col("value").alias("node"))
    return nodes.where(F.schema_of_variant("node").startswith("OBJECT"))


def scan_csv(spark: SparkSession, path: str, columns: tuple[str, ...], exact: bool = False) -> DataFrame:
    """A CSV file with a header as text columns, empty cells as ''. exact: the header is `columns`, in order; else it has them."""
    raw = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').csv(path)
    (checks.header_is if exact else checks.header_has)(raw.columns, columns)
    return raw.select(*(blank(F.col(f"`{c}`")).alias(c) for c in (columns if exact else raw.columns)))


def scan_table(spark: SparkSession, path: str, spec: TableSpec, expected: DataFrame | None = None) -> DataFrame:
    """A normalised table in CSV: exact header, not empty, keys filled and unique. expected: (n), the number of rows it should have.

    All of it is checked in one pass over the rows; only a failure reads them again, for its first cases.
    """
    df = scan_csv(spark, path, spec.fields, exact=True)
    n, flawed = checks.key_summary(df, spec.keys).first()
    if flawed:
        checks.enforce("keys are filled and unique", checks.key_violations(df, spec.keys))
    if not n:
        raise checks.CheckFailed("table is not empty: it has no rows")
    if expected is not None and (told := [r.n for r in expected.collect()]) != [n]:
        raise checks.CheckFailed(f"counts are the manifest's: {n} rows instead of {told}")
    return df


def scan_exclusions(spark: SparkSession, path: str) -> DataFrame:
    """(domain, reason), one row per domain; both have to be filled. Of several reasons the greatest counts."""
    rows = scan_csv(spark, path, ("domain", "reason")).select(strip_host(F.col("domain")).alias("domain"), clean(F.col("reason")).alias("reason"))
    checks.enforce("exclusions have domain and reason", rows.where("domain = '' OR reason = ''"))
    return rows.groupBy("domain").agg(F.max("reason").alias("reason"))


def scan_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(key, value) of a manifest, a JSON object in one file. Fails if the root is no object."""
    root = spark.read.format("json").option("singleVariantColumn", "v").option("multiLine", True).load(path)
    checks.enforce("manifest root is an object", root.where(~F.coalesce(F.schema_of_variant("v").startswith("OBJECT"), F.lit(False))))
    return root.lateralJoin(spark.tvf.variant_explode(F.col("v").outer())).select("key", F.try_variant_get("value", "$", "string").alias("value"))


def variant_text(node: Column, path: str) -> Column:
    """Text of a scalar in a variant: booleans as True or '', zero, objects and arrays as ''."""
    kind = F.schema_of_variant(F.try_variant_get(node, path, "variant"))
    text = F.try_variant_get(node, path, "string")
    return F.when(kind.rlike("^(OBJECT|ARRAY|VOID)"), "").when(kind == "BOOLEAN", F.when(text == "true", "True").otherwise("")).when(kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)") & (F.try_variant_get(node, path, "double") == 0), "").otherwise(F.coalesce(text, F.lit("")))


def _list(node: Column, path: str) -> Column:
    """The array of variants at path; empty if there is none."""
    there = F.schema_of_variant(F.try_variant_get(node, path, "variant")).startswith("ARRAY")
    return F.when(there, F.try_variant_get(node, path, "array<variant>")).otherwise(F.array().cast("array<variant>"))


def driver_hashes(nodes: DataFrame) -> DataFrame:
    """Driver feed -> one row per valid SHA-256 with seven sets of values as text. Fails if there is none."""
    node = F.col("node")
    tags = F.when(F.schema_of_variant(F.try_variant_get(node, "$.Tags", "variant")).startswith("ARRAY"), F.transform(_list(node, "$.Tags"), lambda x: F.try_variant_get(x, "$", "string"))).otherwise(F.array(variant_text(node, "$.Tags")))
    about = [variant_text(node, f"$.{c}").alias(c) for c in ("Category", "Verified", "Id", "Created")]
    samples = nodes.select(*about, tags.alias("tags"), F.explode(_list(node, "$.KnownVulnerableSamples")).alias("s")).where(F.schema_of_variant("s").startswith("OBJECT"))
    s = F.col("s")
    hashes = [valid_hash(variant_text(s, f"$.{c}"), n).alias(c.lower()) for c, n in (("SHA256", 64), ("SHA1", 40), ("MD5", 32))]
    names = F.concat(F.array(variant_text(s, "$.Filename"), variant_text(s, "$.OriginalFilename")), F.col("tags"))
    rows = samples.select("Category", "Verified", "Id", "Created", *hashes, names.alias("names"))
    return group_hashes(rows.select("sha256", "sha1", "md5", F.explode("names").alias("driver_name"), F.col("Category").alias("category"), F.col("Verified").alias("verified"), F.col("Id").alias("source_id"), F.col("Created").alias("created")))


def group_hashes(samples: DataFrame) -> DataFrame:
    """Samples of any number for a SHA-256 -> one row, each other column the sorted set of its values as text."""
    others = ("sha1", "md5", "driver_name", "category", "verified", "source_id", "created")
    return samples.where("sha256 <> ''").groupBy("sha256").agg(*(unique_text(F.col(c)).alias(c) for c in others))


def rmm_domains(feed: DataFrame) -> DataFrame:
    """RMM feed (URI, RMM_Tool) -> (domain, rmm_tool, pattern, regex), one row per pattern and tool; all columns follow from these two."""
    rows = feed.select(F.lower(clean(F.col("URI"))).alias("pattern"), clean(F.col("RMM_Tool")).alias("rmm_tool")).where("pattern <> '' AND rmm_tool <> ''").distinct()
    return rows.select(domain_root(F.col("pattern")).alias("domain"), "rmm_tool", "pattern", glob_regex(F.col("pattern")).alias("regex"))


def split_excluded(rows: DataFrame, exclusions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(effective rows, excluded rows with exclusion_reason), by exact domain; Spark broadcasts the exclusions if they are small."""
    marked = rows.join(exclusions.select("domain", F.col("reason").alias("exclusion_reason")), "domain", "left").select(*rows.columns, "exclusion_reason")
    return marked.where("exclusion_reason IS NULL").drop("exclusion_reason"), marked.where("exclusion_reason IS NOT NULL")


def broad_domains(rows: DataFrame) -> DataFrame:
    """Rows whose domain was cut from an embedded glob, which may be a public suffix; for review."""
    return rows.where(F.col("pattern").rlike(r"[*\[{]") & ~F.col("pattern").startswith("*."))
