"""Quality rules whose cutoffs carry a guarantee: at most a stated share of good documents is lost.

Each rule scores how bad a document looks. The labelled documents are a holdout (no rule is
fitted to them), in which equal texts count once. Per stratum and rule, cutoffs are tested from the
most lenient one down, each by an exact binomial test of whether it rejects at most the rule's share
of `risk` of the good documents, until a test fails: such a fixed sequence needs no correction for the
number of cutoffs. Rules have equal shares of `risk` and `delta`, and `delta` is divided by the number of strata,
which corrects for rules and strata (Bonferroni). Of the cutoffs that pass, the one that rejects the most bad
documents over good ones is used; a stratum without proof keeps everything. Only DataFrame functions
are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.llm.common import spaced, stage

#: Fixed value: characters counted as symbols.
SYMBOLS = "#*$%&|<>"
#: The base rule.
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: Candidate cutoffs of each rule lie on a grid of this many steps between 0 and 1.
STEPS = 100
METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_unlettered", "n_lines", "text_key")
#: Shares of the rules in risk and delta: equal, whatever the labels of a run say.
RULES = ("symbols", "unlettered", "dup_lines", "repeats")
SHARES = {rule: 1 / len(RULES) for rule in RULES}
#: Good documents of a stratum that may be lost, and the chance that more are, over all strata: the user's choice, by default the usual level for both.
RISK, DELTA = 0.05, 0.05
#: Bits of a 64-bit sort key that hold a window's place; the rest hold its hash.
PLACE_BITS = 24


def _neighbours(a: Column, make) -> Column:
    """make(x, y) for each element and its successor."""
    n = F.size(a)
    return F.zip_with(F.slice(a, 1, F.greatest(n - 1, F.lit(0))), F.slice(a, 2, F.greatest(n - 1, F.lit(0))), make)


def _covered(places: Column) -> Column:
    """Words covered by windows of three words that start at the (sorted, distinct) places."""
    gaps = F.aggregate(_neighbours(places, lambda a, b: F.least(b - a, F.lit(3).cast("bigint"))), F.lit(0).cast("bigint"), lambda s, x: s + x)
    return F.when(F.size(places) == 0, F.lit(0).cast("bigint")).otherwise(gaps + 3)


def metrics(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with the columns METRICS (long), counted over each whole text; columns of those names are replaced.

    A null text has no words, symbols or lines; n_unlettered counts words without a letter; text_key is a hash of the text. Windows of three words are compared by 64-bit
    hashes of their words, in one sorted array of (hash, place) keys per text, so that a text of
    n words costs n log n whatever repeats in it.
    """
    mask = (1 << PLACE_BITS) - 1
    text_col = F.coalesce(F.col(text), F.lit(""))
    kept = [c for c in docs.columns if c not in METRICS]
    symbols = text_col
    for c in SYMBOLS:
        symbols = F.replace(symbols, F.lit(c), F.lit(""))
    lines = F.filter(F.split(text_col, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = docs.select(*kept, spaced(F.col(text)).alias("__tw_spaced"), lines.alias("__tw_lines"), (F.length(text_col) - F.length(symbols)).alias("__tw_symbols"), F.xxhash64(text_col).alias("__tw_text_key"))
    df = df.select(*kept, F.array_remove(F.split("__tw_spaced", " "), "").alias("__tw_words"), F.length(F.replace(F.col("__tw_spaced"), F.lit(" "), F.lit(""))).alias("__tw_chars"), "__tw_lines", "__tw_symbols", "__tw_text_key")
    counts = [
        F.size("__tw_words").cast("bigint").alias("n_words"),
        F.col("__tw_chars").cast("bigint").alias("word_chars"),
        F.col("__tw_symbols").cast("bigint").alias("n_symbols"),
        (F.size("__tw_lines") - F.size(F.array_distinct("__tw_lines"))).cast("bigint").alias("n_dup_lines"),
        F.size(F.filter("__tw_words", lambda w: ~w.rlike(r"\p{L}"))).cast("bigint").alias("n_unlettered"),
        F.size("__tw_lines").cast("bigint").alias("n_lines"),
        F.col("__tw_text_key").alias("text_key"),
    ]
    df = df.select(*kept, *counts, F.transform("__tw_words", lambda w: F.xxhash64(w)).alias("__tw_h"))
    two = _neighbours(F.col("__tw_h"), lambda a, b: F.xxhash64(a, b))
    names = [c for c in METRICS if c != "n_repeat_words"]
    df = df.select(*kept, *names, two.alias("__tw_two"), F.slice("__tw_h", 3, F.greatest(F.size("__tw_h") - 2, F.lit(0))).alias("__tw_third"))
    windows = F.zip_with(F.slice("__tw_two", 1, F.size("__tw_third")), "__tw_third", lambda a, c: F.xxhash64(a, c))
    df = df.select(*kept, *names, windows.alias("__tw_windows"))
    keys = F.sort_array(F.transform("__tw_windows", lambda g, i: F.shiftleft(g, PLACE_BITS).bitwiseOR(i.cast("bigint"))))
    df = df.select(*kept, *names, "__tw_windows", F.size(F.array_distinct("__tw_windows")).alias("__tw_distinct"))
    df = df.select(*kept, *names, "__tw_windows", "__tw_distinct", F.when((F.col("__tw_distinct") < F.size("__tw_windows")) & (F.size("__tw_windows") <= mask), keys).alias("__tw_keys"))
    equal = lambda a, b: F.shiftright(a, PLACE_BITS) == F.shiftright(b, PLACE_BITS)
    first = F.array_compact(_neighbours(F.col("__tw_keys"), lambda a, b: F.when(equal(a, b), a.bitwiseAND(mask))))
    second = F.array_compact(_neighbours(F.col("__tw_keys"), lambda a, b: F.when(equal(a, b), b.bitwiseAND(mask))))
    df = df.select(*kept, *names, "__tw_windows", "__tw_distinct", F.when(F.col("__tw_distinct") < F.size("__tw_windows"), first).alias("__tw_first"), F.when(F.col("__tw_distinct") < F.size("__tw_windows"), second).alias("__tw_second"))
    # The keys' shorter hashes are exact if they tell as many windows apart as the whole ones; else whole hashes are sorted.
    pairs = F.array_sort(F.transform("__tw_windows", lambda g, i: F.struct(g.alias("g"), i.cast("bigint").alias("i"))))
    df = df.select(*kept, *names, F.sort_array(F.array_distinct(F.concat("__tw_first", "__tw_second"))).alias("__tw_places"), F.when((F.col("__tw_distinct") < F.size("__tw_windows")) & ~F.coalesce(F.size("__tw_windows") - F.size("__tw_first") == F.col("__tw_distinct"), F.lit(False)), pairs).alias("__tw_pairs"))
    slow = F.concat(F.array_compact(_neighbours(F.col("__tw_pairs"), lambda a, b: F.when(a.g == b.g, a.i))), F.array_compact(_neighbours(F.col("__tw_pairs"), lambda a, b: F.when(a.g == b.g, b.i))))
    df = df.select(*kept, *names, F.when(F.col("__tw_pairs").isNotNull(), F.sort_array(F.array_distinct(slow))).otherwise(F.coalesce("__tw_places", F.array().cast("array<bigint>"))).alias("__tw_places"))
    return df.select(*kept, *names, _covered(F.col("__tw_places")).alias("n_repeat_words")).select(*kept, *METRICS)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def scores() -> dict[str, Column]:
    """The rules: each from 0 (fine) to 1 (bad), rounded up to the grid's step as an integer."""

    def share(part: Column, whole: Column) -> Column:
        return F.ceil(F.least(F.lit(1.0), part / F.greatest(whole, F.lit(1))) * STEPS).cast("int")

    return {
        "symbols": share(F.col("n_symbols"), F.col("n_words")),
        "unlettered": share(F.col("n_unlettered"), F.col("n_words")),
        "dup_lines": share(F.col("n_dup_lines"), F.col("n_lines")),
        "repeats": share(F.col("n_repeat_words"), F.col("n_words")),
    }


def _tail(n: Column, k: Column, p: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, p), by the exact sum of its terms in logarithms.

    Above the mean the tail is at least about a half, which no test here accepts; it is given as 1 there.
    """
    start = F.struct((n * F.log(F.lit(1 - p))).alias("term"), F.exp(n * F.log(F.lit(1 - p))).alias("total"))

    def step(s: Column, i: Column) -> Column:
        term = s.term + F.log((n - i + 1) / i) + F.log(F.lit(p / (1 - p)))
        return F.struct(term.alias("term"), (s.total + F.exp(term)).alias("total"))

    few = F.when(k > 0, F.sequence(F.lit(1).cast("bigint"), F.greatest(k, F.lit(1).cast("bigint")))).otherwise(F.array().cast("array<bigint>"))
    return F.when(k >= n * p, F.lit(1.0)).otherwise(F.aggregate(few, start, step, lambda s: F.least(s.total, F.lit(1.0))))


def thresholds(measured: DataFrame, labels: DataFrame, stratum: str = "lang", doc_id: str = "doc_id", risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """One row (stratum, rule, cutoff, n_good, n_lost, n_bad, n_caught) for each cutoff in use.

    measured: documents with METRICS; labels: (doc_id, quality), 1 good and 0 bad; ids that are
    null, unknown or labelled both ways take no part, nor do texts of a stratum whose copies are
    labelled both ways; other copies count once. Documents that fail the base rule don't
    either, since no cutoff decides on them. With probability 1 - delta, over all strata at
    once, the rules together lose at most the share `risk` of each stratum's good texts.
    """
    clear = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("_doc")).agg(F.min("quality").alias("_q"), F.max("quality").alias("_most")).where("_q = _most").drop("_most")
    rules = scores()
    scored = measured.where(~base_failed()).select(F.col(doc_id).alias("_doc"), F.col(stratum).alias("stratum"), "text_key", *(c.alias(name) for name, c in rules.items()))
    texts = scored.join(clear, "_doc").groupBy("stratum", "text_key", *rules).agg(F.min("_q").alias("_q"), F.max("_q").alias("_most")).where("_q = _most")
    held = texts.select("stratum", "_q", F.explode(F.create_map(*(x for name in rules for x in (F.lit(name), F.col(name))))).alias("rule", "score"))
    # A step's count is spread over the cutoffs below its score: at most STEPS rows for each stratum, rule and label.
    steps = stage(held.groupBy("stratum", "rule", "score").agg(F.count_if(F.col("_q") == 1).alias("good"), F.count_if(F.col("_q") == 0).alias("bad")), "steps")
    grid = F.sequence(F.lit(0), F.lit(STEPS - 1))
    at = steps.select("stratum", "rule", "score", "good", "bad", F.explode(grid).alias("cutoff"))
    over = F.col("score") > F.col("cutoff")
    curve = at.groupBy("stratum", "rule", "cutoff").agg(
        F.sum("good").alias("n_good"), F.sum(F.when(over, F.col("good")).otherwise(0)).alias("n_lost"),
        F.sum("bad").alias("n_bad"), F.sum(F.when(over, F.col("bad")).otherwise(0)).alias("n_caught"),
    )
    strata = max(1, steps.select("stratum").distinct().count())
    # What is lost grows as the cutoff falls, and the test's tail with it, so the cutoffs that pass are those before the first failure.
    safe = F.lit(False)
    for rule, share in SHARES.items():
        safe = safe | ((F.col("rule") == rule) & (_tail(F.col("n_good"), F.col("n_lost"), risk * share) <= delta * share / strata))
    gain = F.col("n_caught") - F.col("n_lost")
    best = F.max(F.struct(gain.alias("gain"), "cutoff", "n_good", "n_lost", "n_bad", "n_caught")).alias("best")
    return curve.where(safe & (gain > 0)).groupBy("stratum", "rule").agg(best).select("stratum", "rule", "best.cutoff", "best.n_good", "best.n_lost", "best.n_bad", "best.n_caught")


def judge(measured: DataFrame, cutoffs: DataFrame, stratum: str = "lang") -> DataFrame:
    """measured with base_failed and kept (boolean, never null).

    kept is false if base_failed or if the score of a rule is over its stratum's cutoff.
    cutoffs: as from thresholds(); null is a stratum of its own.
    """
    rules = scores()
    wide = cutoffs.groupBy(F.col("stratum").alias("__tw_stratum")).agg(*(F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"__tw_cut_{r}") for r in rules))
    joined = measured.drop("base_failed", "kept").join(wide, F.col(stratum).eqNullSafe(F.col("__tw_stratum")), "left")
    over = F.lit(False)
    for name, score in rules.items():
        over = over | F.coalesce(score > F.col(f"__tw_cut_{name}"), F.lit(False))
    # One comparison, not a conjunction: a filter on kept must not be split and pushed down, where it
    # would take a copy of all that makes the metrics with it.
    kept = F.greatest(base_failed().cast("int"), over.cast("int")) == 0
    joined = joined.withColumn("base_failed", base_failed()).withColumn("kept", kept)
    return joined.drop("__tw_stratum", *(f"__tw_cut_{r}" for r in rules))


def quality_filter(docs: DataFrame, labels: DataFrame, stratum: str = "lang", text: str = "text", doc_id: str = "doc_id", risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """The rows of docs that are kept, with their own columns only.

    Documents are measured once and staged with their counts, from which cutoffs and verdicts
    follow; no text is shuffled. Repeated rows are judged each, null and empty texts fail the base
    rule, an empty table gives an empty one, and columns that are named as the counts come back as they were.
    """
    clash = {c: f"__tw_own_{c}" for c in (*METRICS, "base_failed", "kept") if c in docs.columns}
    measured = stage(metrics(docs.withColumnsRenamed(clash), text), "metrics")
    cutoffs = stage(thresholds(measured, labels, stratum, doc_id, risk, delta), "cutoffs")
    return judge(measured, cutoffs, stratum).where("kept").select(*(F.col(clash.get(c, c)).alias(c) for c in docs.columns))
