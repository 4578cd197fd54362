"""Mixing sources to target weights by pivotal dependent rounding.

A source's documents each have the same expected number of copies, target / size. The whole
part is fixed; the fractional parts are rounded in pairs: copy probability is moved at random
between two documents, in inverse proportion to their sizes, until one of them is 0 or 1. This
keeps every document's expectation and the sum of size x copies. First, each document that
holds over LARGE of its source's words (fewer than 1 / LARGE can) is paired with all documents
after it as one. Then blocks of the others are rounded side by side, each leaves at most one
undecided document, and these residuals are combined by the next level of a reduction tree
until each source has one, which goes to the nearer side. A source thus misses its target by at
most half a document, and by half a document that isn't large unless those are all it has. Only DataFrame functions are used; chance comes
from hashes, so reruns agree.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewell.llm.common import stage, words

#: A source takes at most so many times its size.
MOST = 3
#: Weights of the sources in order of their code points, null last, repeating.
WEIGHTS = (1, 2, 3)
#: Documents that one block of the reduction tree rounds in sequence.
BLOCK = 128
#: Share of its source's words from which a document is rounded against the whole rest of the source.
LARGE = 1 / 500
#: Rows of one range of the sources' order.
RANGE = 100_000


def _uniform(*parts: Column | int) -> Column:
    """A number in (0, 1) from a hash of the parts."""
    h = F.xxhash64(*(F.lit(p) if isinstance(p, int) else p for p in parts))
    return (F.shiftrightunsigned(h, 11).cast("double") + 0.5) / float(1 << 53)


def weigh(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """sources (source, source_size) with the weight of each by its place in code point order, null last."""
    count = sources.count()
    ranges = max(1, -(-count // RANGE))
    spread = stage(sources.repartitionByRange(ranges, F.col("source").asc_nulls_last()).withColumn("_range", F.spark_partition_id()), "sources")
    before = spread.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))  # one row for each RANGE sources
    before = before.select("_range", F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)).alias("_before"))
    place = F.coalesce("_before", F.lit(0)) + F.row_number().over(Window.partitionBy("_range").orderBy(F.col("source").asc_nulls_last())) - 1
    kinds = F.array(*(F.lit(w) for w in weights))
    return spread.join(before, "_range").select("source", "source_size", F.get(kinds, F.pmod(place, F.lit(len(weights))).cast("int")).alias("weight"))


def targets(sources: DataFrame, most: float = MOST) -> DataFrame:
    """sources (source, source_size, weight) with target: their weights' shares of all sizes.

    A target stops at `most` times its source's size; the excess goes to the others by weight,
    and so on until none is above. Each round is one sum over the sources; one number goes to the driver.
    """
    sources = stage(sources, "weighted")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    limit = F.col("source_size") * float(most)
    unit = 0.0  # words for one unit of weight
    while True:
        full = limit < F.col("weight") * unit
        held, rest = sources.agg(F.sum(F.when(full, limit).otherwise(0.0)), F.sum(F.when(full, 0).otherwise(F.col("weight")))).first()
        if not rest:
            break
        new = (total - held) / rest
        if new <= unit:
            break
        unit = new
    return sources.withColumn("target", F.least(limit, F.col("weight") * F.lit(float(unit))))


def _block(units: Column, seed: int, level: int) -> Column:
    """Rounds an array of (unit, weight, p) in sequence; struct (decided: array of (unit, up), rest: (unit, weight, p) or null)."""

    def step(state: Column, b: Column) -> Column:
        a = state.rest
        raise_a = F.least(1 - a.p, b.p * b.weight / a.weight)
        lower_a = F.least(a.p, (1 - b.p) * b.weight / a.weight)
        up = _uniform(seed, level, a.unit.key, b.unit.key) * (raise_a + lower_a) < lower_a
        # a goes up: either a reaches 1 or b reaches 0; a goes down: either a reaches 0 or b reaches 1.
        a_done = F.when(up, 1 - a.p <= b.p * b.weight / a.weight).otherwise(a.p <= (1 - b.p) * b.weight / a.weight)
        move = F.when(up, raise_a).otherwise(-lower_a)
        a_p, b_p = a.p + move, b.p - move * a.weight / b.weight
        done = F.struct(F.when(a_done, a.unit).otherwise(b.unit).alias("unit"), F.when(a_done, up).otherwise(~up).alias("up"))
        left = F.when(a_done, F.struct(b.unit.alias("unit"), b.weight.alias("weight"), b_p.alias("p"))).otherwise(F.struct(a.unit.alias("unit"), a.weight.alias("weight"), a_p.alias("p")))
        # Both may be done at once; what is left is then 0 or 1 but for rounding errors.
        both = (left.p <= 1e-12) | (left.p >= 1 - 1e-12)
        also = F.struct(left.unit.alias("unit"), (left.p > 0.5).alias("up"))
        moved = F.struct(
            F.concat(state.decided, F.when(both, F.array(done, also)).otherwise(F.array(done))).alias("decided"),
            F.when(~both, left).alias("rest"),
        )
        return F.when(a.isNull(), F.struct(state.decided.alias("decided"), b.alias("rest"))).otherwise(moved)

    start = F.struct(F.array().cast(f"array<struct<unit:{UNIT},up:boolean>>").alias("decided"), F.lit(None).cast(f"struct<unit:{UNIT},weight:double,p:double>").alias("rest"))
    return F.aggregate(units, start, step)


UNIT = "struct<doc_id:bigint,source:string,size:bigint,key:bigint,rows:bigint>"


def _large(units: Column, p: Column, total: Column, seed: int) -> Column:
    """Rounds large units, largest first, each against all that follows as one unit.

    units: array of (unit, weight); p: what all documents of the source start with; total: the
    weight of all. Struct (decided, rest: an undecided unit or null, p: of the documents that
    follow, left: their weight).
    """

    def step(state: Column, a: Column) -> Column:
        left = F.greatest(state.left - a.weight, F.lit(0.0))
        ratio = left / a.weight
        raise_a = F.least(1 - state.p, state.p * ratio)
        lower_a = F.least(state.p, (1 - state.p) * ratio)
        up = _uniform(seed, -1, a.unit.key) * (raise_a + lower_a) < lower_a
        a_done = F.when(up, 1 - state.p <= state.p * ratio).otherwise(state.p <= (1 - state.p) * ratio)
        move = F.when(up, raise_a).otherwise(-lower_a)
        others = F.when(a_done, F.least(F.greatest(state.p - move / ratio, F.lit(0.0)), F.lit(1.0))).otherwise(F.when(up, 0.0).otherwise(1.0))
        paired = F.struct(
            F.when(a_done, F.concat(state.decided, F.array(F.struct(a.unit.alias("unit"), up.alias("up"))))).otherwise(state.decided).alias("decided"),
            F.when(~a_done, F.struct(a.unit.alias("unit"), a.weight.alias("weight"), (state.p + move).alias("p"))).alias("rest"),
            others.alias("p"),
            left.alias("left"),
        )
        # Once all that follows is decided, so is the next.
        settled = F.struct(F.concat(state.decided, F.array(F.struct(a.unit.alias("unit"), (state.p > 0.5).alias("up")))).alias("decided"), state.rest.alias("rest"), state.p.alias("p"), left.alias("left"))
        last = F.struct(state.decided.alias("decided"), F.struct(a.unit.alias("unit"), a.weight.alias("weight"), state.p.alias("p")).alias("rest"), state.p.alias("p"), left.alias("left"))
        return F.when((state.p <= 1e-12) | (state.p >= 1 - 1e-12), settled).when(left <= 0, last).otherwise(paired)

    start = F.struct(F.array().cast(f"array<struct<unit:{UNIT},up:boolean>>").alias("decided"), F.lit(None).cast(f"struct<unit:{UNIT},weight:double,p:double>").alias("rest"), p.alias("p"), total.alias("left"))
    return F.aggregate(units, start, step)


def _key(doc_id: str, source: str, text: str) -> Column:
    """Hash of what makes a unit; hashes skip nulls, so these are told by marks of their own."""
    return F.xxhash64(F.col(doc_id), *(x for c in (source, text) for x in (F.col(c).isNull(), F.col(c))))


def mix(docs: DataFrame, source: str = "source", text: str = "text", doc_id: str = "doc_id", weights: tuple[int, ...] = WEIGHTS, most: float = MOST, seed: int = 0) -> DataFrame:
    """One row per row of docs: doc_id, source, key, size, source_size, target (all of its source) and copies (int).

    size is the number of words in the text (null: 0). Rows that agree in doc_id, source and text
    are one unit and get the same copies each; key tells units of one doc_id apart. A null
    source is a source of its own. Documents without words get as many copies as their
    source's share, rounded by chance each.
    """
    measured = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(source).cast("string").alias("source"), F.size(words(F.col(text))).cast("bigint").alias("size"), _key(doc_id, source, text).alias("key"))
    units = stage(measured.groupBy("doc_id", "source", "size", "key").agg(F.count(F.lit(1)).alias("rows")), "units")
    sources = units.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.count(F.lit(1)).alias("n_units"))
    sources = stage(sources, "source-sizes")
    goals = stage(targets(weigh(sources.drop("n_units"), weights), most), "targets").select(F.col("source").alias("_source"), "source_size", "target")
    goals = goals.join(sources.select(F.col("source").alias("_s"), "n_units"), F.col("_source").eqNullSafe(F.col("_s"))).drop("_s")
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    goals = stage(goals.select("_source", "source_size", "target", "n_units", share.alias("share")), "shares")
    unit = F.struct("doc_id", "source", "size", "key", "rows").alias("unit")
    whole = F.floor("share")
    parts = units.join(goals, F.col("source").eqNullSafe(F.col("_source"))).select(unit, "source", "source_size", "n_units", (F.col("size") * F.col("rows")).cast("double").alias("weight"), (F.col("share") - whole).alias("p"))
    settled = lambda p: (p <= 1e-12) | (p >= 1 - 1e-12)
    empty = parts.where(F.col("weight") == 0).select("unit", (_uniform(seed, F.col("unit.key")) < F.col("p")).alias("up"))
    is_large = F.col("weight") > F.col("source_size") * LARGE
    order = F.array_sort(F.collect_list(F.struct((-F.col("weight")).alias("first"), F.xxhash64(F.lit(seed), "unit.key").alias("at"), "unit", "weight")))
    large = parts.where(is_large).groupBy("source").agg(order.alias("units"), F.max("source_size").cast("double").alias("total"), F.max("p").alias("p"), F.max("n_units").alias("n_units"))
    large = stage(large.select("source", "n_units", _large(F.col("units"), F.col("p"), F.col("total"), seed).alias("node")), "large")
    rest = parts.where(~is_large & (F.col("weight") > 0)).join(large.select(F.col("source").alias("_s"), F.col("node.p").alias("_p")), F.col("source").eqNullSafe(F.col("_s")), "left")
    rest = rest.select("unit", "n_units", "weight", F.coalesce("_p", "p").alias("p"))
    decided = [empty, large.select(F.inline("node.decided")), rest.where(settled(F.col("p"))).select("unit", (F.col("p") > 0.5).alias("up"))]
    undecided = large.where("node.rest IS NOT NULL").select("node.rest.unit", "n_units", "node.rest.weight", "node.rest.p")
    open_ = rest.where(~settled(F.col("p"))).unionByName(undecided)
    most_units = sources.agg(F.max("n_units")).first()[0] or 0
    level = 0
    while most_units > 1:
        blocks = F.ceil(F.col("n_units") / BLOCK)
        nodes = open_.groupBy(F.col("unit.source").alias("source"), F.pmod(F.xxhash64(F.lit(seed), F.lit(level), "unit.key"), blocks).alias("block"))
        drawn = F.array_sort(F.collect_list(F.struct((-F.col("weight")).alias("first"), F.xxhash64(F.lit(seed), F.lit(~level), "unit.key").alias("at"), "unit", "weight", "p")))
        rounded = nodes.agg(drawn.alias("units"), F.max("n_units").alias("n_units")).select("n_units", _block(F.transform("units", lambda x: F.struct(x.unit.alias("unit"), x.weight.alias("weight"), x.p.alias("p"))), seed, level).alias("node"))
        rounded = stage(rounded, f"level{level}")
        decided.append(rounded.select(F.inline("node.decided")))
        open_ = rounded.where("node.rest IS NOT NULL").select("node.rest.unit", F.ceil(F.col("n_units") / BLOCK).alias("n_units"), "node.rest.weight", "node.rest.p")
        most_units = -(-most_units // BLOCK)
        level += 1
    decided.append(open_.select("unit", (F.col("p") > 0.5).alias("up")))
    ups = reduce(DataFrame.unionAll, decided).select("unit.*", F.col("up").cast("int").alias("up"))
    told = ups.join(goals, F.col("source").eqNullSafe(F.col("_source"))).select("doc_id", "source", "key", "size", "source_size", "target", "rows", (whole.cast("int") + F.col("up")).alias("copies"))
    return told.select("doc_id", "source", "key", "size", "source_size", "target", F.explode(F.sequence(F.lit(1).cast("bigint"), "rows")).alias("_row"), "copies").drop("_row")


def repeat(docs: DataFrame, source: str = "source", text: str = "text", doc_id: str = "doc_id", weights: tuple[int, ...] = WEIGHTS, most: float = MOST, seed: int = 0) -> DataFrame:
    """The mixture itself: each row of docs as often as mix() has copies of it, with the columns of docs."""
    copies = mix(docs, source, text, doc_id, weights, most, seed).groupBy(F.col("doc_id").alias("__tw_doc"), F.col("key").alias("__tw_key")).agg(F.max("copies").alias("__tw_copies"))
    keyed = docs.withColumn("__tw_row_key", _key(doc_id, source, text))
    same = (F.col("__tw_row_key") == F.col("__tw_key")) & F.col(doc_id).cast("bigint").eqNullSafe(F.col("__tw_doc"))
    taken = keyed.join(copies.where("__tw_copies > 0"), same)
    return taken.select(*(F.col(c) for c in docs.columns), F.explode(F.sequence(F.lit(1), "__tw_copies")).alias("__tw_copy")).drop("__tw_copy")
