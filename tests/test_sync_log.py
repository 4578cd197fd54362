"""Atomic publishing, failures by tenant, the change log and reconciliation by digests."""

import random
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tracewell.operators import changelog, checks, sinks, sync

SCHEMA = "tenant string, k string, v string, w int"
KEYS, GROUPS = ("tenant", "k"), ["tenant"]


def table(spark, rows):
    return spark.createDataFrame([(t, k, v, w) for (t, k), (v, w) in rows.items()], SCHEMA).coalesce(1)


def rows_of(spark, path):
    return {(r.tenant, r.k): (r.v, r.w) for r in sync.read_version(spark, path).collect()}


def statuses(report):
    return {r.tenant: r.status for r in report.collect()}


def test_publish_at_once(spark, tmp_path):
    """Of two threads that publish from one version, one succeeds, 100 times; the pointer is the winner's."""
    path = str(tmp_path / "t")

    def publish(name, before):
        try:
            return name, sinks.publish(spark, path, name, 1, before)
        except checks.Conflict:
            return name, None

    before = None
    with ThreadPoolExecutor(2) as pool:
        for i in range(100):
            told = list(pool.map(lambda side, i=i, before=before: publish(f"{side}{i}", before), "ab"))
            won = [x for x in told if x[1]]
            assert len(won) == 1 and won[0][1] == i + 1
            pointer = (tmp_path / "t" / "_pointers" / f"{i + 1:012d}.json").read_text()
            assert f'"version": "{won[0][0]}"' in pointer
            before = type("Before", (), {"seq": i + 1})
    assert sinks.current(spark, path).seq == 100
    assert not [p for p in (tmp_path / "t" / "_pointers").iterdir() if p.name.startswith(".")]


def test_publish_by_rename(spark, tmp_path):
    """The way of file systems other than the local one: a rename that doesn't overwrite."""
    path = f"viewfs://store/{tmp_path.name}"
    spark._jsparkSession.sessionState().conf().setConfString("fs.viewfs.mounttable.store.link./" + tmp_path.name, f"file://{tmp_path}")
    spark.conf.set("fs.viewfs.mounttable.store.link./" + tmp_path.name, f"file://{tmp_path}")
    assert sinks.create_once(spark, f"{path}/p/1", "one") and not sinks.create_once(spark, f"{path}/p/1", "two")
    assert (tmp_path / "p" / "1").read_text() == "one" and not [x for x in (tmp_path / "p").iterdir() if x.name not in ("1", ".1.crc")]


def test_failures_by_tenant(spark, tmp_path):
    """A tenant whose changes aren't right as written keeps its rows; so do those with bad keys or too many deletes; the others go on."""
    path = str(tmp_path / "t")
    old = {(t, str(k)): ("old", k) for t in "abcde" for k in range(8)}
    assert set(statuses(sync.sync_all(table(spark, old), path, GROUPS, KEYS)).values()) == {"ok"}
    new = {(t, str(k)): ("new" if k % 2 else "old", k) for t in "abcd" for k in range(8)} | {("a", "9"): (None, None)}
    del new["b", "0"], new["b", "1"]
    for k in "01234":
        del new["c", k]
    wanted = table(spark, new).unionByName(table(spark, {("d", ""): ("x", 1)}))
    report = sync.sync_all(wanted, path, GROUPS, KEYS, write=lambda rows, to: rows.withColumn("v", F.when(F.col("tenant") == "b", F.upper("v")).otherwise(F.col("v"))).write.parquet(to))
    assert statuses(report) == {"a": "ok", "b": "verify failed", "c": "guarded", "d": "bad keys"}
    assert {r.tenant: (r.n_upsert, r.n_stale, r.n_current, r.n_desired) for r in report.collect()} == {"a": (5, 0, 8, 9), "b": (3, 2, 8, 6), "c": (2, 5, 8, 3), "d": (0, 0, 8, 9)}
    assert rows_of(spark, path) == {**{k: x for k, x in old.items() if k[0] != "a"}, **{k: x for k, x in new.items() if k[0] == "a"}}
    # Nothing is left but what the pointers name, and the next sync finishes the rest.
    assert {p.name.split("-")[0] for p in (tmp_path / "t").iterdir()} == {"changes", "digests", "_pointers"}
    fine = {x: v for x, v in new.items() if x[0] in "ab"}
    assert statuses(sync.sync_all(table(spark, fine), path, GROUPS, KEYS)) == {"a": "ok", "b": "ok"}
    assert {k: x for k, x in rows_of(spark, path).items() if k[0] in "ab"} == fine


def test_all_writes_wrong(spark, tmp_path):
    """If the others' changes are wrong too, nothing is published."""
    path = str(tmp_path / "t")
    old = {(t, "1"): ("old", 1) for t in "ab"}
    sync.sync_all(table(spark, old), path, GROUPS, KEYS)
    turns = []

    def write(rows, to):
        turns.append(to)
        rows.where(F.col("tenant") == ("a" if len(turns) == 1 else "none")).write.parquet(to)

    with pytest.raises(checks.CheckFailed, match="wanted"):
        sync.sync_all(table(spark, {k: ("new", 1) for k in old}), path, GROUPS, KEYS, write=write)
    assert rows_of(spark, path) == old


def test_conflict(spark, tmp_path):
    """Another sync publishes while this one writes: its rows stay, and this one's groups are reported."""
    path = str(tmp_path / "t")
    sync.sync_all(table(spark, {("a", "1"): ("old", 1)}), path, GROUPS, KEYS)

    def write(rows, to):
        sync.sync_all(table(spark, {("a", "1"): ("theirs", 2)}), path, GROUPS, KEYS)
        rows.write.parquet(to)

    assert statuses(sync.sync_all(table(spark, {("a", "1"): ("mine", 3)}), path, GROUPS, KEYS, write=write)) == {"a": "conflict"}
    assert rows_of(spark, path) == {("a", "1"): ("theirs", 2)}


def test_change_log(spark, tmp_path, monkeypatch):
    """Random syncs against a dictionary; what is written follows the changes; merging changes nothing."""
    monkeypatch.setattr(changelog, "FOLD", 4)
    path, chance, model = str(tmp_path / "t"), random.Random(3), {}
    sizes, merged = [], 0
    for turn in range(9):
        for t in chance.sample("abc", 2):
            for _ in range(200 if turn == 0 else chance.randint(0, 3)):
                key = t, str(chance.randint(0, 300))
                if turn and chance.random() < 0.3:
                    model.pop(key, None)
                else:
                    model[key] = chance.choice([None, "x", "y"]), chance.choice([None, 1, 2])
        report = sync.sync_all(table(spark, model), path, GROUPS, KEYS, override=True)
        assert set(statuses(report).values()) == {"ok"}
        assert rows_of(spark, path) == model
        pointer = sinks.current(spark, path)
        merged += pointer.version is not None and not pointer.changes
        if pointer.changes:
            sizes.append((sum(r.n_upsert + r.n_stale for r in report.collect()), pointer.changes[-1].n))
    assert merged >= 1 and sizes[0][1] > 200
    assert max(n for _, n in sizes[1:]) < 12 and all(a in (0, n) for a, n in sizes)
    changelog.compact(spark, path, GROUPS)
    assert not changelog.compact(spark, path, GROUPS) and rows_of(spark, path) == model
    before = sinks.current(spark, path).seq
    assert set(statuses(sync.sync_all(table(spark, model), path, GROUPS, KEYS)).values()) == {"ok"}
    assert sinks.current(spark, path).seq == before  # nothing to do, nothing published


def plan_rows(df):
    return sorted((r.tenant, r.k, r.op, None if r.new is None else tuple(r.new)) for r in df.collect())


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_reconcile(spark, monkeypatch, seed):
    """Equal to the full join, whatever the number of buckets; nulls differ from values and change places with them."""
    monkeypatch.setattr(changelog, "BUCKETS", [1, 7, 256][seed - 1])
    chance = random.Random(seed)
    sides = []
    for _ in range(2):
        sides.append({(t, str(k)): (chance.choice([None, "", "x"]), chance.choice([None, 0])) for t in "abc" for k in range(60) if chance.random() < 0.9})
    sides[1].update({x: v for x, v in sides[0].items() if x[0] == "a" or chance.random() < 0.8})
    one, other = (table(spark, x) for x in sides)
    full = sync.plan_changes(one, other, KEYS).where("op <> 'same'")
    for groups in (GROUPS, []):
        assert plan_rows(sync.reconcile(one, other, KEYS, groups)) == plan_rows(full)
    assert plan_rows(sync.reconcile(one, one, KEYS, GROUPS)) == [] and len(plan_rows(sync.reconcile(one, one.where("false"), KEYS, GROUPS))) == len(sides[0])


def test_only_differing_buckets_are_read(spark, tmp_path):
    """The base is laid out by buckets: a reader of some skips the others' row groups, and its plan pushes the buckets down."""
    path = str(tmp_path / "t")
    rows = spark.range(20_000).select(F.lit("a").alias("tenant"), F.col("id").cast("string").alias("k"), F.lit("x" * 20).alias("v"), F.lit(1).alias("w"))
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        sync.write_version(rows, path, KEYS, groups=GROUPS)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    some = changelog.read(spark, path, buckets=[3, 77])
    assert "In(_bucket, [3,77])" in some._jdf.queryExecution().executedPlan().toString()
    assert some.count() == changelog.bucketed(rows, KEYS).where("_bucket IN (3, 77)").count() < 300
