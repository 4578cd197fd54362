"""Feeds, matching, checks, sync and streams on small hand-made tables."""

import csv
import io
import json
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tracewell.functions import text as T
from tracewell.operators import checks, matching, sinks, sync
from tracewell.plans import detections, mirror
from tracewell.sources import feeds
from tracewell.sources.specs import DRIVER_HASHES, RMM_DOMAINS
from tracewell.streaming import jobs

A, B, C = "a" * 64, "b" * 40, "c" * 32


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "v string").select(f(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    ("uri", "domain", "regex"),
    [
        ("*.example.com", "example.com", r"^(?:.*\.example\.com)$"),
        ("relay-[a-f0-9]{8}.net.anydesk.com:443", "anydesk.com", r"^(?:relay-[a-f0-9]{8}\.net\.anydesk\.com)$"),
        ("plus*.site24x7.net.au", "net.au", r"^(?:plus.*\.site24x7\.net\.au)$"),
        ("https://Host.Example./p", "host.example", r"^(?:host\.example)$"),
        ("*", "", "^(?:.*)$"),
        ("a[b.c", "a[b.c", r"^(?:a\[b\.c)$"),
        ("", "", "^(?:)$"),
    ],
)
def test_patterns(spark, uri, domain, regex):
    assert one(spark, uri, T.domain_root) == domain
    assert one(spark, uri, T.glob_regex) == regex


def test_hash_and_space(spark):
    assert one(spark, "　" + A.upper() + "\n", lambda c: T.valid_hash(c, 64)) == A
    assert one(spark, A + "0", lambda c: T.valid_hash(c, 64)) == ""
    assert one(spark, None, T.clean) == ""


def test_url_host(spark):
    assert one(spark, "https://A.Example:8/x", T.url_host) == "a.example"
    assert one(spark, "example.com", T.url_host) is None
    assert one(spark, "Example.com", lambda c: T.url_host(c, bare=True)) == "example.com"
    assert one(spark, "ht!tp://%%", T.url_host) is None


DRIVERS = [
    {"Id": "driver-1", "Tags": "one.sys", "Category": "vulnerable driver", "Verified": "TRUE", "Created": "2026-01-01", "KnownVulnerableSamples": [{"SHA256": A.upper(), "SHA1": B.upper(), "MD5": C.upper(), "Filename": "one.sys"}, 5]},
    {"Id": "driver-2", "Tags": ["duplicate.sys"], "Category": "malicious", "Verified": "TRUE", "Created": "2026-01-01", "KnownVulnerableSamples": [{"SHA256": A, "SHA1": "bad"}]},
    {"Id": "driver-3", "Tags": None, "KnownVulnerableSamples": "none"},
    {"Id": "driver-4", "Verified": True, "KnownVulnerableSamples": [{"SHA256": "bad"}]},
    "not an object",
]


@pytest.fixture
def landed(tmp_path):
    (tmp_path / "drivers.json").write_text("﻿" + json.dumps(DRIVERS), encoding="utf-8")
    (tmp_path / "rmm.csv").write_text("﻿URI,RMM_Tool,Other\nGetScreen.me,Tool,x\ngetscreen.me,Tool,y\n*.a.test,T2,\ngithub.com,T3,\nnezha.github.io,T4,\n,T5,\n", encoding="utf-8")
    (tmp_path / "exclusions.csv").write_text("domain,reason\ngithub.com,shared host\n")
    return tmp_path


def test_mirror_and_verified_load(spark, landed):
    out = str(landed / "out")
    counts = {r.name: r.n for r in mirror.build(spark, str(landed / "drivers.json"), str(landed / "rmm.csv"), str(landed / "exclusions.csv"), out).collect()}
    assert counts == {"driver_hash_rows": 1, "rmm_upstream_rows": 4, "rmm_excluded_rows": 1, "rmm_effective_rows": 3, "rmm_domain_rows": 3}
    row = mirror.verified_load(spark, out, DRIVER_HASHES, "driver_hash_rows").collect()
    assert [tuple(r) for r in row] == [(A, B, C, "duplicate.sys;one.sys", "malicious;vulnerable driver", "TRUE", "driver-1;driver-2", "2026-01-01")]
    loaded = mirror.verified_load(spark, out, RMM_DOMAINS, "rmm_effective_rows")
    assert [r.domain for r in loaded.orderBy("domain").collect()] == ["a.test", "getscreen.me", "nezha.github.io"]
    with pytest.raises(checks.CheckFailed):
        mirror.verified_load(spark, out, RMM_DOMAINS, "driver_hash_rows")


def build(spark, landed, **more):
    return mirror.build(spark, *(str(landed / n) for n in ("drivers.json", "rmm.csv", "exclusions.csv")), str(landed / "out"), **more)


def test_mirror_again(spark, landed):
    """A refresh replaces the tables; the manifest has both locations, four hashes and five integers; damage is found."""
    build(spark, landed)
    (landed / "rmm.csv").write_text("URI,RMM_Tool\nnew.test,T\n")
    build(spark, landed, sources={"drivers_url": "https://a.test/d.json", "rmm_url": "https://a.test/r.csv"})
    out = str(landed / "out")
    assert [r.domain for r in mirror.verified_load(spark, out, RMM_DOMAINS, "rmm_effective_rows").collect()] == ["new.test"]
    at = landed / "out" / sinks.current(spark, out).version
    manifest = json.loads(next((at / "manifest").glob("part*")).read_text())
    assert {k: v for k, v in manifest.items() if not k.endswith("sha256")} == {"drivers_url": "https://a.test/d.json", "rmm_url": "https://a.test/r.csv", "driver_hash_rows": 1, "rmm_upstream_rows": 1, "rmm_excluded_rows": 0, "rmm_effective_rows": 1, "rmm_domain_rows": 1}
    assert list(manifest) == sorted(manifest) and sum(len(str(v)) == 64 for v in manifest.values()) == 4
    targets = spark.createDataFrame([("x", True), ("y", False), ("z", True)], "tenant string, enabled boolean")
    root = str(landed / "tables")
    told = [(r.dataset, r.tenant, r.n_upsert, r.status) for r in mirror.sync_mirror(spark, out, targets, root).collect()]
    assert told == [(d, t, 1, "ok") for d in ("driver_hashes", "rmm_domains") for t in ("x", "z")]
    csv = next((at / "rmm_domains").glob("*.csv"))
    csv.chmod(0o644)
    csv.write_text(csv.read_text().replace("new.test", "bad.test"))
    (at / "rmm_domains" / f".{csv.name}.crc").unlink()
    with pytest.raises(checks.CheckFailed, match="hash"):
        mirror.verified_load(spark, out, RMM_DOMAINS, "rmm_effective_rows")
    told = [(r.dataset, r.tenant, r.n_upsert, r.status) for r in mirror.sync_mirror(spark, out, targets, root).collect()]
    assert told == [("driver_hashes", "x", 0, "ok"), ("driver_hashes", "z", 0, "ok"), ("rmm_domains", "x", 0, "bad source"), ("rmm_domains", "z", 0, "bad source")]
    (landed / "rmm.csv").write_text("URI,RMM_Tool\n,T\n")
    with pytest.raises(checks.CheckFailed, match="no rows"):
        build(spark, landed)
    assert landed / "out" / sinks.current(spark, out).version == at


URIS = ["*.a{}.test", "h{}.b.test:8443", "https://C{}.Test/p/q", "r-[a-f0-9]{{2,8}}.net.d{}.test", "x*.e{}.co.test.", "{{p,q}}.f{}.test", "g+{}.test", "a[b.{}.test", " h{}.test ", "*", "*.*.i{}.test", "UP{}.shared.test"]


def plain_row(uri, tool):
    """(domain, tool, pattern, regex) of a feed's row, in plain Python."""
    pattern = uri.strip().lower()
    host = re.sub(r":[0-9]+$", "", re.sub(r"^[a-z][a-z0-9+.-]*://", "", pattern).split("/")[0]).rstrip(".")
    labels = [x for x in host.split(".") if x]
    domain = host[2:] if host.startswith("*.") else host if not set("*[{") & set(host) else ".".join(labels[-2:]) if len(labels) > 1 else ""
    parts = re.findall(r"\[[^\]]*\]|\{[^}]*\}|.", host)
    regex = "".join(".*" if x == "*" else x if len(x) > 1 else "\\" + x if x in ".+?()|^$\\[{" else x for x in parts)
    return domain, tool, pattern, f"^(?:{regex})$"


def test_whole_feed(spark, landed):
    """Some hundred rows of all kinds, with repeated and incomplete ones, give the table of a plain version, byte for byte."""
    feed = [(u.format(i), f"Tool {i % 7}") for i in range(30) for u in URIS] + [("H1.B.TEST:8443", "Tool 1"), ("", "T"), ("no.tool.test", " ")]
    excluded = {"shared.test", "up3.shared.test", "h5.test", "a0.test"}
    with (landed / "rmm.csv").open("w", newline="") as f:
        csv.writer(f).writerows([("URI", "RMM_Tool"), *feed])
    (landed / "exclusions.csv").write_text("domain,reason\n" + "".join(f"{d},r\n" for d in sorted(excluded)))
    counts = {r.name: r.n for r in build(spark, landed).collect()}
    rows = sorted({plain_row(u, t) for u, t in feed if u.strip() and t.strip()})
    kept = [r for r in rows if r[0] not in excluded]
    assert (counts["rmm_upstream_rows"], counts["rmm_excluded_rows"], counts["rmm_effective_rows"]) == (len(rows), len(rows) - len(kept), len(kept)) and len(rows) > len(kept)
    wanted = io.StringIO()
    csv.writer(wanted, lineterminator="\n").writerows([RMM_DOMAINS.fields, *kept])
    at = landed / "out" / sinks.current(spark, str(landed / "out")).version
    assert next((at / "rmm_domains").glob("*.csv")).read_text() == wanted.getvalue()


def test_failing_checks(spark, landed):
    with pytest.raises(checks.CheckFailed):
        checks.enforce("has rows", checks.empty(spark.range(0)))
    checks.enforce("has rows", checks.empty(spark.range(1)))
    with pytest.raises(checks.CheckFailed):
        checks.no_other_columns(["a", "b", "c"], ("a",), ("b",))
    checks.no_other_columns(["a", "b"], ("a",), ("b",))
    (landed / "none").write_text("")
    (landed / "large").write_text("x" * 11)
    (landed / "fits").write_text("x" * 10)
    assert [checks.size_violations(spark, str(landed / n), 10).count() for n in ("none", "large", "fits")] == [1, 1, 0]
    (landed / "unreasoned.csv").write_text("domain,reason\na.test,\n")
    with pytest.raises(checks.CheckFailed):
        feeds.scan_exclusions(spark, str(landed / "unreasoned.csv"))
    rows = spark.createDataFrame([("a", None), (None, "x"), ("", "y"), ("b", "z"), ("b", "z")], "k string, v string")
    assert {(r.k, r.violation) for r in checks.key_violations(rows, ("k",)).collect()} == {(None, "empty key"), ("", "empty key"), ("b", "duplicate key")}


def test_incomplete_read_and_second_writer(spark, tmp_path):
    path, df = str(tmp_path / "t"), spark.range(10).withColumnRenamed("id", "k").repartition(2)
    sync.write_version(df, path, ("k",), max_records=3)
    files = sorted((tmp_path / "t" / sinks.current(spark, path).version).glob("*.parquet"))
    assert len(files) >= 4
    with pytest.raises(checks.Conflict):
        sinks.publish(spark, path, "other", 1, None)
    files[0].unlink()
    with pytest.raises(checks.CheckFailed, match="complete"):
        sync.read_version(spark, path)


def test_sync_all(spark, tmp_path):
    """One job for all tenants: bad keys and too many deletes leave a tenant as it is, and others that aren't named too."""
    path, keys = str(tmp_path / "t"), ("tenant", "k")
    df = lambda rows: spark.createDataFrame(rows, "tenant string, k string, v string")
    sync.sync_all(df([(t, k, "old") for t in "abcd" for k in "1234"]), path, ["tenant"], keys)
    wanted = df([("a", k, "new") for k in "1235"] + [("b", "1", "new"), ("b", "1", "twice")] + [("c", "1", "new")])
    told = [tuple(r) for r in sync.sync_all(wanted, path, ["tenant"], keys).collect()]
    assert told == [("a", 4, 1, 4, 4, "ok"), ("b", 0, 0, 4, 2, "bad keys"), ("c", 1, 3, 4, 1, "guarded")]
    rows = sorted(tuple(r) for r in sync.read_version(spark, path).collect())
    assert rows == [("a", k, "new") for k in "1235"] + [(t, k, "old") for t in "bcd" for k in "1234"]
    sync.sync_all(df([("c", "1", "new")]), path, ["tenant"], keys, override=True)
    assert sync.read_version(spark, path).groupBy("tenant").count().orderBy("tenant").collect() == [("a", 4), ("b", 4), ("c", 1), ("d", 4)]


def test_feed_root_and_headers(spark, landed):
    (landed / "object.json").write_text("{}")
    with pytest.raises(checks.CheckFailed):
        feeds.scan_json(spark, str(landed / "object.json"))
    with pytest.raises(checks.CheckFailed):
        feeds.scan_csv(spark, str(landed / "rmm.csv"), ("URI", "Missing"))
    with pytest.raises(checks.CheckFailed):
        feeds.scan_csv(spark, str(landed / "rmm.csv"), ("URI", "RMM_Tool"), exact=True)


HOSTS = ["anydesk.com", "x.anydesk.com", "evil-anydesk.com", "x.anydesk.com.bad.test", "boot.net.anydesk.com", "anydesk.computer", "x.any.computer", "", None, "com", "a.com.b"]
DOMAINS = ["anydesk.com", "net.anydesk.com", "any.com", "com", "", None]


def test_theta_forms(spark):
    hosts, domains = spark.createDataFrame([(h,) for h in HOSTS], "host string"), spark.createDataFrame([(d,) for d in DOMAINS], "domain string")
    pairs = [(h, d) for h in HOSTS for d in DOMAINS if h and d]
    got = {tuple(r) for r in matching.suffix_pairs(hosts, domains).collect()}
    assert got == {(h, d) for h, d in pairs if h == d or h.endswith("." + d)}
    got = {tuple(r) for r in matching.contains_pairs(hosts, domains).collect()}
    assert got == {(h, d) for h, d in pairs if h == d or "." + d in h}


def at(h, m=0):
    return datetime(2026, 1, 2, h, m)


def loads(spark, rows):
    return spark.createDataFrame(rows, "ts timestamp_ntz, report_id long, device_id string, action string, file_name string, sha1 string, sha256 string")


def test_driver_loads(spark):
    rows = [
        (at(12), 1, "d", "DriverLoad", "f", B, A.upper()),
        (at(12), 2, "d", "DriverLoad", "f", B, A.upper()),
        (at(8), 3, "d", "DriverLoad", "g", B, A),  # at the edge: out
        (at(11), 4, "d", "Other", "h", B, A),
        (at(11), 5, "d", "DriverLoad", "i", "e" * 40, None),
    ]
    drivers = spark.createDataFrame([(A, B, "one"), ("f" * 64, "e" * 40 + ";" + "d" * 40, "two")], "sha256 string, sha1 string, driver_name string")
    as_of = F.lit(at(12)).cast("timestamp_ntz")
    got = detections.detect_driver_loads(loads(spark, rows), drivers, as_of).collect()
    assert [(r.report_id, r.event_count, r.sha256, r.driver_name) for r in got] == [(2, 2, A.upper(), "one")]
    both = detections.detect_driver_loads(loads(spark, rows), drivers, as_of, split_multi=True).collect()
    assert {r.driver_name for r in both} == {"one", "two"}


def test_no_nested_loops(spark, sf):
    from tracewell.plans import catalog

    for name in ("detect_driver_loads", "report_rmm_suffix", "report_rmm_contains", "detect_module_loads"):
        plan = catalog.QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan, name


def table(spark, rows):
    return spark.createDataFrame(rows, "pattern string, rmm_tool string, domain string")


KEYS = ("pattern", "rmm_tool")


def test_sync_table(spark, tmp_path):
    path = str(tmp_path / "t")
    first = table(spark, [("a", "T", "1"), ("b", "T", "2"), ("c", "T", None), ("d", "T", "4")])
    assert sync.sync_table(first, path, KEYS, dry_run=True).where("op = 'insert'").count() == 4
    assert sync.read_version(spark, path, first.schema).count() == 0
    sync.sync_table(first, path, KEYS)
    assert {r.op for r in sync.sync_table(first, path, KEYS).collect()} == {"same"}
    one_left = table(spark, [("a", "T", "x")])
    with pytest.raises(checks.CheckFailed):
        sync.sync_table(one_left, path, KEYS)
    assert sync.read_version(spark, path).count() == 4
    three = table(spark, [("a", "T", "x"), ("b", "T", "2"), ("c", "T", None)])  # exactly a quarter goes
    ops = {r.pattern: r.op for r in sync.sync_table(three, path, KEYS).collect()}
    assert ops == {"a": "update", "b": "same", "c": "same", "d": "stale"}
    sync.sync_table(one_left, path, KEYS, override=True)
    assert [tuple(r) for r in sync.read_version(spark, path).collect()] == [("a", "T", "x")]
    with pytest.raises(checks.CheckFailed):
        sync.sync_table(table(spark, [("a", "T", "x"), ("a", "T", "y")]), path, KEYS)
    with pytest.raises(checks.CheckFailed):
        sync.sync_table(table(spark, [("", "T", "x")]), path, KEYS, override=True)


def test_targets(spark):
    targets = spark.createDataFrame([("x", True), ("y", False), ("z", True)], "tenant string, enabled boolean")
    assert {r.tenant for r in sync.select_targets(targets).collect()} == {"x", "z"}
    assert {r.tenant for r in sync.select_targets(targets, ["z"]).collect()} == {"z"}
    with pytest.raises(checks.CheckFailed):
        sync.select_targets(targets, ["y"])


def test_streams(spark, tmp_path):
    rows = [(at(1), 1, A), (at(2), 2, "0" * 64), (at(3), 3, A), (at(3), 3, A), (datetime(2026, 1, 20), 4, A)]
    events = spark.createDataFrame(rows, "ts timestamp_ntz, report_id long, sha256 string")
    events.coalesce(1).write.parquet(str(tmp_path / "events"))
    drivers = spark.createDataFrame([(A, "one")], "sha256 string, driver_name string")
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "events"))

    def run(df, name):
        q = df.writeStream.format("memory").queryName(name).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        assert q.awaitTermination(120)
        return spark.table(name).collect()

    assert sorted(r.report_id for r in run(jobs.module_load_alerts(stream, drivers), "alerts")) == [1, 3, 4]
