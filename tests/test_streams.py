"""Stream jobs over several batches, with late rows and indicators that change, against the batch plans."""

import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tracewell.plans import detections, mirror
from tracewell.operators import matching
from tracewell.streaming import jobs

START = datetime(2026, 1, 5)
SCHEMA = "ts timestamp_ntz, report_id long, device_id string, action string, host string, process string, user string, sub_type string, path string, command string, port int"
HOSTS = ["a.test", "r1.net.a.test", "xa.test", "OK.a.test", "b.co.test", "b.co.test.evil.test", "", None, "c.test"]
DOMAINS = [("a.test", "T1", "*.a.test"), ("a.test", "T2", "a.test"), ("net.a.test", "T1", "*.net.a.test"), ("b.co.test", "T3", "b.co.test"), ("evi", "T4", "evi*"), (None, "T5", "x"), ("", "T5", "y")]


def some_rows(seed, first, n, hours):
    chance = random.Random(seed)
    out = []
    for i in range(n):
        at = START + timedelta(hours=chance.uniform(*hours))
        out.append((at.replace(microsecond=0), first + i, chance.choice("de"), chance.choice(["ConnectionSuccess", "ConnectionSuccess", "Failed"]), chance.choice(HOSTS), chance.choice(["p", None]), chance.choice("uv"), chance.choice("st"), "/p", chance.choice(["x", None]), i))
    return out


@pytest.fixture
def landed(spark, tmp_path):
    """Four files, one a batch: days 0 to 6, days 5 to 13 with late rows, day 12, and rows long behind the watermark with one that moves it on."""
    late = some_rows(9, 9000, 5, (1, 20))
    files = [some_rows(1, 0, 150, (0, 150)), some_rows(2, 1000, 150, (140, 310)), some_rows(3, 2000, 20, (290, 310)), late + [(START + timedelta(days=60), 9999, "d", "ConnectionSuccess", "far.test", "p", "u", "s", "/p", "x", 0)]]
    for i, rows in enumerate(files):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        newest = max((tmp_path / "in").glob("*.parquet"), key=lambda p: p.stat().st_mtime_ns)
        stamp = 1_700_000_000 + 100 * i
        import os

        os.utime(newest, (stamp, stamp))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    return stream, [r for rows in files[:3] for r in rows], tmp_path


def run(spark, df, name, at):
    q = df.writeStream.format("memory").queryName(name).option("checkpointLocation", str(at / name)).trigger(availableNow=True).start()
    assert q.awaitTermination(240)
    assert len(q.recentProgress) >= 4
    return spark.table(name)


def comparable(df, columns):
    return sorted((tuple(sorted(x) if isinstance(x, list) else x for x in r) for r in df.select(*columns).collect()), key=str)


def windows(got):
    """Windows that came out, a week long each, one starting every day."""
    out = sorted({(r.window_start, r.window_end) for r in got.select("window_start", "window_end").distinct().collect()})
    assert all(b - a == timedelta(days=7) for a, b in out)
    return out


def within(spark, rows, start, end):
    zone = F.lit
    return spark.createDataFrame(rows, SCHEMA).where((F.col("ts") >= zone(start)) & (F.col("ts") < zone(end)))


def test_report_by_windows(spark, landed):
    """Each window's report is the batch report of its rows; rows behind the watermark don't come back."""
    stream, rows, at = landed
    domains = spark.createDataFrame(DOMAINS, "domain string, rmm_tool string, pattern string")
    allowed = spark.createDataFrame([("ok.A.test",)], "host string")
    got = run(spark, jobs.rmm_report(stream, domains, allowed, late="24 HOURS"), "rmm_windows", at)
    columns = ["device_id", "host", "domain", "process", "report_id", "action", "user", "port", "event_count", "rmm_tools", "patterns"]
    seen = windows(got)
    assert len(seen) >= 18
    for start, end in seen:
        day = within(spark, rows, start, end)
        wanted = detections.report_rmm_suffix(day, domains, allowed, F.lit(end).cast("timestamp_ntz"), "8 DAYS")
        mine = got.where((F.col("window_start") == start))
        assert comparable(mine, columns) == comparable(wanted, columns), start
        assert comparable(mine, ["first_seen"])[0][0] >= start
    assert got.where("report_id >= 9000").count() == 0
    assert {r.host for r in got.select("host").distinct().collect()} == {"a.test", "r1.net.a.test", "b.co.test"}


def test_summary_by_windows(spark, landed):
    stream, rows, at = landed
    domains = spark.createDataFrame(DOMAINS, "domain string, rmm_tool string, pattern string")
    got = run(spark, jobs.rmm_summary(stream, domains, late="24 HOURS"), "rmm_sets", at)
    columns = ["device_id", "host", "process", "domain", "event_count", "users", "actions", "sub_types", "paths", "commands", "rmm_tools", "patterns"]
    for start, end in windows(got)[::4]:
        wanted = detections.report_rmm_contains(within(spark, rows, start, end), domains, F.lit(end).cast("timestamp_ntz"), "8 DAYS")
        assert comparable(got.where(F.col("window_start") == start), columns) == comparable(wanted.where("host <> ''"), columns), start
    assert "b.co.test.evil.test" in {r.host for r in got.select("host").distinct().collect()}


def test_contained_by_brute_force(spark):
    chance = random.Random(4)
    name = lambda most: ".".join("".join(chance.choices("ab", k=chance.randint(1, 3))) for _ in range(chance.randint(1, most)))
    hosts, domains = [name(5) for _ in range(300)], sorted({name(3) for _ in range(60)})
    rows = spark.createDataFrame(list(enumerate(hosts)), "id long, host string")
    for some in (domains, [d for d in domains if "." in d], [d for d in domains if "." not in d], []):
        got = matching.match_contained(rows, spark.createDataFrame([(d,) for d in some], "domain string"))
        assert sorted((r.id, r.domain) for r in got.collect()) == sorted((i, d) for i, h in enumerate(hosts) for d in some if h == d or "." + d in h)


A, B, C, D = "a" * 64, "b" * 40, "c" * 64, "d" * 40


def build(spark, at, hashes):
    (at / "drivers.json").write_text(json.dumps([{"Id": "x", "Tags": f"{s[:2]}.sys", "KnownVulnerableSamples": [{"SHA256": s, "SHA1": h}]} for s, h in hashes]))
    (at / "rmm.csv").write_text("URI,RMM_Tool\na.test,T\n")
    (at / "exclusions.csv").write_text("domain,reason\nb.test,r\n")
    mirror.build(spark, *(str(at / n) for n in ("drivers.json", "rmm.csv", "exclusions.csv")), str(at / "mirror"))


def test_alerts_follow_the_indicators(spark, tmp_path):
    """Matches by either hash; a new version counts from the next batch on; a batch that runs again gives the same rows once."""
    loads = "ts timestamp_ntz, report_id long, device_id string, action string, file_name string, sha1 string, sha256 string"

    def land(*rows):
        spark.createDataFrame([(START + timedelta(minutes=r[0]), r[0], "d", r[3] if len(r) > 3 else "DriverLoad", "f", r[2], r[1]) for r in rows], loads).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def step():
        q = jobs.driver_load_alerts(spark.readStream.schema(loads).parquet(str(tmp_path / "in")), str(tmp_path / "mirror"), str(tmp_path / "out"), str(tmp_path / "check")).trigger(availableNow=True).start()
        assert q.awaitTermination(240)
        return sorted((r.report_id, r.driver_name, r.indicators) for r in spark.read.parquet(str(tmp_path / "out")).collect())

    build(spark, tmp_path, [(A, B)])
    land((1, A.upper(), B), (2, None, B.upper()), (3, C, D), (4, A, None, "Other"), (1, A.upper(), B))
    first = [(1, "aa.sys", 1), (2, "aa.sys", 1)]
    assert step() == first
    build(spark, tmp_path, [(A, B), (C, D)])
    land((5, C, None), (6, "0" * 64, D), (7, "0" * 64, "0" * 40), (2, None, B.upper()))
    both = [*first, (5, "cc.sys", 2), (6, "cc.sys", 2)]
    assert step() == both
    last = max((tmp_path / "check" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    for p in (last, last.with_name(f".{last.name}.crc")):
        p.unlink(missing_ok=True)
    build(spark, tmp_path, [(A, B), (C, D), ("e" * 64, "e" * 40)])
    assert [r[:2] for r in step()] == [r[:2] for r in both]
