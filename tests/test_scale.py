"""Plans that have to hold at scale: what is pruned, thinned, split and read once."""

import json
import random

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tracewell.operators import changelog, checks, matching, sync
from tracewell.plans import detections, mirror
from tracewell.sources import feeds, json_arrays, telemetry
from tracewell.sources.specs import DRIVER_HASHES


def leaves(df):
    """The scans of a plan that has run, in all its stages."""

    def of(plan):
        name = plan.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return of(plan.executedPlan())
        if name.endswith("QueryStageExec"):
            return of(plan.plan())
        found = plan.collectLeaves()
        return [x for i in range(found.size()) for x in ([found.apply(i)] if not found.apply(i).getClass().getSimpleName().endswith(("QueryStageExec", "SparkPlanExec")) else of(found.apply(i)))]

    return of(df._jdf.queryExecution().executedPlan())


def metric(node, name):
    return node.metrics().apply(name).value()


def rows_read(spark, run):
    """Rows that scans of files have read while run() went on."""
    sc = spark.sparkContext._jsc.sc()
    quantiles = spark.sparkContext._gateway.new_array(spark._jvm.double, 0)

    def read():
        sc.listenerBus().waitUntilEmpty()
        stages = sc.statusStore().stageList(None, False, False, quantiles, None)
        return {(s.stageId(), s.attemptId()): s.inputRecords() for s in (stages.apply(i) for i in range(stages.size()))}

    known = read()
    run()
    return sum(n for i, n in read().items() if i not in known)


def month(spark):
    """30 days with an event every ten minutes."""
    return spark.range(30 * 144).select(F.col("id").alias("report_id"), F.expr("timestamp_ntz'2026-01-01' + make_interval(0, 0, 0, 0, 0, 10 * cast(id as int))").alias("ts"), F.lit("DriverLoad").alias("action"))


@pytest.mark.parametrize("dynamic", [False, True])
def test_lookback_prunes_days(spark, tmp_path, dynamic):
    """4 hours of 30 days read the files of two days at most, also if the bound is found while the query runs."""
    path = str(tmp_path / "events")
    telemetry.append(month(spark), path)
    table = telemetry.read(spark, path)
    as_of = month(spark).agg(F.max("ts")).scalar() if dynamic else F.lit("2026-01-30 23:50:00").cast("timestamp_ntz")
    recent = detections.lookback(table, "ts", as_of, "4 HOURS")
    assert len(recent.collect()) == 24  # the edge itself is out
    scan = next(x for x in leaves(recent) if x.getClass().getSimpleName() == "FileSourceScanExec")
    assert "event_date" in scan.metadata().apply("PartitionFilters") and "GreaterThan(ts" in scan.metadata().apply("PushedFilters") or dynamic
    files = len(list((tmp_path / "events").rglob("*.parquet")))
    assert files >= 30 and metric(scan, "numFiles") <= 2 and metric(scan, "numPartitions") <= 2
    assert sorted(tuple(r) for r in table.drop("event_date").collect()) == sorted(tuple(r) for r in month(spark).collect())


def test_late_and_null_times(spark, tmp_path):
    path = str(tmp_path / "events")
    rows = spark.createDataFrame([(1, None), (2, "2026-01-01 10:00:00"), (3, "2026-01-01 06:00:00")], "report_id long, t string").select("report_id", F.col("t").cast("timestamp_ntz").alias("ts"))
    telemetry.append(rows, path)
    telemetry.append(rows.where("report_id = 2").withColumn("report_id", F.lit(4).cast("long")), path)
    recent = telemetry.lookback(telemetry.read(spark, path), "ts", F.lit("2026-01-01 10:00:00").cast("timestamp_ntz"), "4 HOURS")
    assert sorted(r.report_id for r in recent.collect()) == [2, 4]


def test_indicators_that_are_not_broadcast(spark):
    """What the filter of hashes lets through goes into the exchange: all matches, and few others."""
    events = spark.range(50_000).select(F.col("id").alias("report_id"), F.sha2(F.col("id").cast("string"), 256).alias("sha256"), F.sha1(F.col("id").cast("string")).alias("sha1"))
    known = spark.range(0, 4_000_000, 200).select(F.sha2(F.col("id").cast("string"), 256).alias("sha256"), F.sha1((F.col("id") + 1).cast("string")).alias("sha1"), F.lit("x").alias("driver_name"))
    columns = {"sha256": "sha256", "sha1": "sha1"}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        thin, plain = (matching.match_either(events, known, columns, thin=t).select("report_id", "driver_name") for t in (True, False))
        rows = sorted(r.report_id for r in thin.collect())
        assert rows == sorted(r.report_id for r in plain.collect()) == sorted(i for k in range(0, 50_000, 200) for i in (k, k + 1))
        text = thin._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in text and text.count("BroadcastHashJoin") >= 1 and "NestedLoop" not in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    seen = events.select(F.explode(F.array("sha256", "sha1")).alias("h"))
    hashes = known.select(F.explode(F.array("sha256", "sha1")).alias("h"))
    assert 500 <= matching.thinned(seen, hashes, "h").count() < 500 + 0.05 * 100_000  # of 100,000
    assert matching.thinned(seen, hashes.where("false"), "h").count() == 0


def test_filter_of_fixed_size(spark, monkeypatch):
    """More indicators than the filter has room for: it lets more through, and loses none."""
    monkeypatch.setattr(matching, "MOST_BITS", 1024)
    seen = spark.range(3000).select(F.col("id").cast("string").alias("h"))
    hashes = spark.range(0, 3000, 3).select(F.col("id").cast("string").alias("h"))
    got = {r.h for r in matching.thinned(seen, hashes, "h").collect()}
    assert got >= {str(i) for i in range(0, 3000, 3)}


VALUES = [{"a": 1, "b": [1, 2, {"c": "x,y"}]}, "text, with ] and \" and \\ and \\\"", 5, None, [], {}, [[1, 2], [3]], {"k, \"]": "[{,"}, {"last\\": "\\\\"}, {"é,": "中,文"}]


def array_rows(spark, path):
    return [json.loads(r.text) for r in json_arrays.elements(spark, str(path)).orderBy("at").collect()]


def test_arrays_cut_anywhere(spark, tmp_path):
    """The same elements wherever Spark cuts the file, with a byte order mark, white space and line ends."""
    at = tmp_path / "a.json"
    at.write_text("﻿ [" + ",\n ".join(json.dumps(v, ensure_ascii=False) for v in VALUES) + "\n]\n", encoding="utf-8")
    size, before = at.stat().st_size, spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for cut in (size + 1, size - 1, *range(7, 60, 9), 101):
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(cut))
            assert array_rows(spark, at) == VALUES, cut
        blocks = json_arrays._pieces(spark, str(at)).select("block").distinct().count()
        assert blocks > 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_array_files_are_read_twice(spark, tmp_path):
    """Once for the ranges' states and once for the pieces, which are kept: what follows reads the kept table."""
    values = [{"k": i, "t": "a, b"} for i in range(2000)]
    (tmp_path / "a.json").write_text(json.dumps(values))
    pieces = json_arrays._pieces(spark, str(tmp_path / "a.json")).count()
    plans = json_arrays.elements(spark, str(tmp_path / "a.json"))
    assert "Format: Text" not in plans._jdf.queryExecution().executedPlan().toString()
    assert pieces == 3 * len(values) and array_rows(spark, tmp_path / "a.json") == values


@pytest.mark.parametrize(("text", "rows"), [("[]", []), (" [ ] ", []), ("[1]", [1]), ("[[]]", [[]]), ("{}", None), ("[1, 2", None), ('["a]', None), ("1, 2", None), ("[1], 2", None), ("", None)])
def test_roots_of_arrays(spark, tmp_path, text, rows):
    (tmp_path / "a.json").write_text(text)
    if rows is not None:
        assert array_rows(spark, tmp_path / "a.json") == rows
    else:
        with pytest.raises((PySparkException, Py4JJavaError, checks.CheckFailed)):
            json_arrays.scan_objects(spark, str(tmp_path / "a.json")).collect()


def test_random_arrays(spark, tmp_path):
    chance = random.Random(9)

    def value(depth):
        kind = chance.randint(0, 5 if depth else 2)
        if kind < 3:
            return chance.choice([1, None, "", 'a"b', "c\\", ",[", "]}", "x,y"])
        if kind == 3:
            return {chance.choice(['k"', "l,", "m\\"]) + str(i): value(depth - 1) for i in range(chance.randint(0, 3))}
        return [value(depth - 1) for _ in range(chance.randint(0, 3))]

    values = [value(3) for _ in range(300)]
    (tmp_path / "a.json").write_text(json.dumps(values))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "997")
    try:
        assert array_rows(spark, tmp_path / "a.json") == values
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def land(at, n):
    drivers = [{"Id": str(i), "Tags": f"{i}.sys", "KnownVulnerableSamples": [{"SHA256": f"{i:064x}"}]} for i in range(n)]
    (at / "drivers.json").write_text(json.dumps([*drivers, 5, "x"]))
    (at / "rmm.csv").write_text("URI,RMM_Tool\n" + "".join(f"h{i}.test,T\n" for i in range(n)))
    (at / "exclusions.csv").write_text("domain,reason\nh1.test,r\n")
    return [str(at / x) for x in ("drivers.json", "rmm.csv", "exclusions.csv")]


def test_one_scan_a_table(spark, tmp_path):
    """A build doesn't read its tables again to count them; a verified load reads the table's rows once, and its file and manifest."""
    paths = land(tmp_path, 300)
    built = rows_read(spark, lambda: mirror.build(spark, *paths, str(tmp_path / "out")))
    # Feeds twice each, since ranges are sampled before a sorted write, and the RMM feed for two tables; with exclusions, archive, hashes.
    assert built < 2 * 300 * 2 + 100
    assert 300 <= rows_read(spark, lambda: mirror.verified_load(spark, str(tmp_path / "out"), DRIVER_HASHES, "driver_hash_rows")) < 330


def test_build_by_ranges(spark, tmp_path):
    """The driver feed by byte ranges gives the same tables."""
    paths = land(tmp_path, 50)
    for split in (False, True):
        mirror.build(spark, *paths, str(tmp_path / f"out{split}"), split=split)
    one, other = (sorted(map(tuple, mirror.verified_load(spark, str(tmp_path / f"out{s}"), DRIVER_HASHES, "driver_hash_rows").collect())) for s in (False, True))
    assert one == other and len(one) == 50
    assert {r.node for r in feeds.scan_json(spark, paths[0]).select(F.to_json("node").alias("node")).collect()} == {r.node for r in json_arrays.scan_objects(spark, paths[0]).select(F.to_json("node").alias("node")).collect()}


def test_sync_reads_the_desired_rows_twice(spark, tmp_path):
    """One scan for the digests, one for the buckets that differ; the table's rows once, where its only file has one row group, and once by its footers."""
    keys = ("tenant", "k")
    rows = spark.range(20_000).select(F.lit("a").alias("tenant"), F.col("id").cast("string").alias("k"), F.lit(1).alias("v"))
    rows.write.parquet(str(tmp_path / "desired"))
    desired = spark.read.parquet(str(tmp_path / "desired"))
    sync.write_version(desired, str(tmp_path / "t"), keys, groups=["tenant"])
    new = desired.withColumn("v", F.when(F.col("k") == "77", 2).otherwise(F.col("v")))
    read = rows_read(spark, lambda: sync.sync_all(new, str(tmp_path / "t"), ["tenant"], keys).collect())
    assert sync.read_version(spark, str(tmp_path / "t")).where("v = 2").count() == 1
    pointed = changelog.read(spark, str(tmp_path / "t"), buckets=[1])
    assert "EqualTo(_bucket,1)" in pointed._jdf.queryExecution().executedPlan().toString()
    assert 60_000 <= read < 85_000
