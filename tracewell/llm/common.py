"""What the operators share: the shared folder, staged tables and text helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space that separates words: [\x20\x09-\x0D].
SPACES = "\t\n\x0b\x0c\r"


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which driver and executors share.

    Where the setting is absent and Spark runs in one local process, a temporary
    folder is made and set; on a cluster its absence is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not (spark.sparkContext.master or "").startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    root = "file://" + tempfile.mkdtemp(prefix="tracewell-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def stage(df: DataFrame, name: str) -> DataFrame:
    """Writes df as a Parquet table in the shared folder and reads it back.

    Cuts lineage so that a lost executor costs one stage, not the whole job, and gives
    Catalyst the real size of the table for its choice of joins.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tracewell/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Deletes tables of stage() that no later job reads, nor any frame still to be run; any other table is refused."""
    for df in tables:
        session = df.sparkSession
        path = session._jvm.org.apache.hadoop.fs.Path
        root = path(f"{shared_dir(session)}/tracewell")
        files = root.getFileSystem(session._jsparkSession.sessionState().newHadoopConf())
        folders = {path(session._jvm.java.net.URI(f)).getParent().toString() for f in df.inputFiles()}
        folder = path(folders.pop()) if len(folders) == 1 else None
        if folder is None or files.makeQualified(folder.getParent()).toString() != files.makeQualified(root).toString():
            raise ValueError("not a staged table")
        files.delete(folder, True)


def small_batches(spark: SparkSession, size: str = "8m") -> None:
    """Bounds Arrow batches by bytes unless the session does: 10,000 long texts take a lot of memory on both sides."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if name not in spark.conf.getAll:
        spark.conf.set(name, size)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spaced(text: Column) -> Column:
    """text (null: empty) with each ASCII white space character as one blank."""
    out = F.coalesce(text, F.lit(""))
    for c in SPACES:
        out = F.replace(out, F.lit(c), F.lit(" "))
    return out


def words(text: Column) -> Column:
    """Array of the words [^\\x20\\x09-\\x0D]+ of text, in order (null: none)."""
    return F.array_remove(F.split(spaced(text), " "), "")
