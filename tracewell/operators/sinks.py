"""Sinks: deterministic CSV, raw archive, manifest, and the pointer that makes a version the current one."""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from tracewell.operators import checks


def write_csv(df: DataFrame, path: str, order: list[str]) -> int:
    """Rows in order under a header in one CSV file, for small exports such as indicator tables; the rows that the writing job itself counted."""
    seen = Observation()
    counted = df.orderBy(*order).coalesce(1).observe(seen, F.count(F.lit(1)).alias("n"))
    counted.write.option("header", True).option("emptyValue", "").option("quote", '"').option("escape", '"').option("lineSep", "\n").csv(path)
    return seen.get["n"]


def archive(spark: SparkSession, source: str, path: str) -> None:
    """Keeps raw payloads as they are: (path, content, length, sha256)."""
    raw = spark.read.format("binaryFile").load(source)
    raw.select("path", "content", "length", F.sha2("content", 256).alias("sha256")).write.mode("append").parquet(path)


def manifest_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(name, n) of each table, in one job."""
    out = None
    for name, df in tables.items():
        row = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
        out = row if out is None else out.unionByName(row)
    return out


def write_manifest(counts: dict[str, int], hashes: DataFrame, sources: dict[str, str], path: str) -> None:
    """One JSON object of source locations, file hashes (name, sha256) and integer counts, keys in order."""
    names = [r.name for r in hashes.select("name").collect()]  # a few files
    found = {n: F.max(F.when(F.col("name") == n, F.col("sha256"))) for n in names}
    values = {**found, **{k: F.first(F.lit(v)) for k, v in sources.items()}, **{k: F.first(F.lit(v).cast("bigint")) for k, v in counts.items()}}
    row = hashes.agg(*(values[k].alias(k) for k in sorted(values)))
    row.select(F.to_json(F.struct(*sorted(values))).alias("value")).coalesce(1).write.text(path)


POINTER = "seq long, version string, n long, keys array<string>, changes array<struct<version: string, n: bigint>>, digests string"


def current(spark: SparkSession, path: str) -> Row | None:
    """The pointer that was published last under path: seq, version, n, keys, changes and digests; None if nothing was."""
    try:
        found = spark.read.json(f"{path}/_pointers", schema=POINTER)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return found.orderBy(F.desc("seq")).first()


def remove(spark: SparkSession, folder: str) -> None:
    """Deletes a folder that the caller has made."""
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Creates a file with its whole text unless it is there; whether it did. Of several writers one does.

    The text is written beside it and gets its place by an operation that fails if the place is
    taken: a hard link on a local or mounted file system, else a rename without overwriting,
    which the file system behind Hadoop's FileContext has to make atomic, as HDFS does.
    """
    jvm, fs = spark._jvm, spark._jvm.org.apache.hadoop.fs
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    target = fs.Path(path)
    files = target.getFileSystem(conf)
    target = files.makeQualified(target)
    own = fs.Path(target.getParent(), f".{uuid.uuid4().hex}")
    out = files.create(own, True)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if target.toUri().getScheme() == "file":
            local = lambda p: jvm.java.nio.file.Paths.get(p.toUri().getPath(), spark.sparkContext._gateway.new_array(jvm.java.lang.String, 0))
            jvm.java.nio.file.Files.createLink(local(target), local(own))
        else:
            options = spark.sparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 0)
            fs.FileContext.getFileContext(target.toUri(), conf).rename(own, target, options)
    except Py4JJavaError as e:
        if not e.java_exception.getClass().getSimpleName().startswith("FileAlreadyExists"):
            raise
        return False
    finally:
        files.delete(own, False)
    return True


def publish(spark: SparkSession, path: str, version: str | None, n: int, before: Row | None, keys: tuple[str, ...] = (), changes: list[tuple[str, int]] | None = None, digests: str | None = None) -> int:
    """Makes a version, with the changes that follow it, the current one of path; returns its number.

    The pointer's place is the number after `before`, so of all writers that go on from one version
    exactly one succeeds, and the others get a Conflict and have changed nothing.
    """
    seq = (before.seq if before else 0) + 1
    listed = [{"version": v, "n": k} for v, k in changes or []]
    text = json.dumps({"seq": seq, "version": version, "n": n, "keys": list(keys), "changes": listed, "digests": digests})
    if not create_once(spark, f"{path}/_pointers/{seq:012d}.json", text + "\n"):
        raise checks.Conflict(f"version {seq} of {path} is another writer's")
    return seq
