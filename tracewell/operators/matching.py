"""Joins of telemetry with indicators: by hash, by domain suffix and by contained domain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.functions.text import not_empty


def join_keep_left(left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str = "inner") -> DataFrame:
    """Equi-join in which the left table keeps columns that both have; the right key goes."""
    other = right.withColumnRenamed(right_key, "_right_key")
    other = other.drop(*(c for c in other.columns if c in left.columns))
    return left.join(other, left[left_key] == other["_right_key"], how).drop("_right_key")


def hash_match(events: DataFrame, indicators: DataFrame, column: str, hash_column: str, split_multi: bool = False) -> DataFrame:
    """Events whose hash is an indicator's, whatever its case, with the indicator's columns; the event's own columns win.

    An indicator with several hashes, joined by ';', matches none of them unless split_multi.
    Repeated matches of one event and indicator are one row only after distinct().
    """
    value = F.lower(F.col(hash_column))
    keyed = indicators.where(not_empty(F.col(hash_column))).withColumn("_hash", F.explode(F.split(value, ";")) if split_multi else value)
    seen = events.where(not_empty(F.col(column))).withColumn("_seen", F.lower(F.col(column)))
    return join_keep_left(seen, keyed, "_seen", "_hash").drop("_seen")


#: Bits of a filter of hashes: so many for each, and at most so many in all, as words of 64 of which three are an entry's (16 MB).
BITS_EACH, MOST_BITS, WORD = 16, 1 << 27, 64


def _entry(hashed: Column, words: int) -> tuple[Column, Column]:
    """(word of the filter, the entry's bits in it) of a 64-bit hash."""
    bits = F.lit(0).cast("bigint")
    for i in range(3):
        bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftright(hashed, 40 + 6 * i).bitwiseAND(63).cast("int")))
    return F.pmod(hashed, F.lit(words)).cast("int"), bits


def thinned(events: DataFrame, indicators: DataFrame, key: str) -> DataFrame:
    """events without most of those whose key no indicator has, before any shuffle of theirs.

    The indicators' hashes make a blocked Bloom filter, MOST_BITS at most, whose words are broadcast: its size is proven, the
    indicators' isn't. An event that an indicator has is never lost; others come through with a chance of some percent, and more
    once the indicators are more than MOST_BITS / BITS_EACH.
    """
    hashed = indicators.select(F.xxhash64(key).alias("_h")).distinct()
    words = max(1, min(MOST_BITS, BITS_EACH * hashed.count()) // WORD)
    word, bits = _entry(F.col("_h"), words)
    table = hashed.select(word.alias("_word"), bits.alias("_bits")).groupBy("_word").agg(F.bit_or("_bits").alias("_bits"))
    word, bits = _entry(F.xxhash64(key), words)
    kept = events.withColumn("_word", word).join(F.broadcast(table), "_word").where(F.col("_bits").bitwiseAND(bits) == bits)
    return kept.drop("_word", "_bits")


def match_either(events: DataFrame, indicators: DataFrame, columns: dict[str, str], split_multi: bool = False, ids: list[str] | None = None, thin: bool = False) -> DataFrame:
    """Distinct matches by any of the hashes in columns (event's column: indicator's): both sides give their hashes with the column's place, for one equi-join, since an OR makes a nested loop.

    ids: columns that tell matches apart, of events and indicators; without them whole rows do. thin: for
    indicators too large to broadcast, whose join shuffles the events: see thinned().
    """

    def hashes(names: list[str], split: bool):
        each = [F.transform(F.split(F.lower(F.col(c)), ";") if split else F.array(F.lower(F.col(c))), lambda h, i=i: F.struct(F.lit(i).alias("kind"), h.alias("hash"))) for i, c in enumerate(names)]
        return F.explode(F.array_distinct(F.filter(F.flatten(F.array_compact(F.array(*each))), lambda x: not_empty(x.hash))))

    seen = events.withColumn("_seen", hashes(list(columns), False))
    keyed = indicators.withColumn("_hash", hashes(list(columns.values()), split_multi))
    if thin:
        seen = thinned(seen, keyed.select(F.col("_hash").alias("_seen")), "_seen")
    matches = join_keep_left(seen, keyed, "_seen", "_hash").drop("_seen")
    return matches.dropDuplicates(ids) if ids else matches.distinct()


def label_suffixes(host: Column) -> Column:
    """The host and all that follows a dot of it, as an array without repeats."""
    labels = F.split(host, r"\.")
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")))


def suffix_pairs(hosts: DataFrame, domains: DataFrame, host: str = "host", domain: str = "domain") -> DataFrame:
    """Distinct (host, domain) where the host is the domain or a subdomain: an equi-join on the host's label suffixes."""
    distinct = hosts.where(not_empty(F.col(host))).select(host).distinct()
    return distinct.select(host, F.explode(label_suffixes(F.col(host))).alias("_suffix")).join(domains.where(not_empty(F.col(domain))).select(F.col(domain).alias("_suffix")).distinct(), "_suffix").select(host, F.col("_suffix").alias(domain))


def match_contained(df: DataFrame, domains: DataFrame, host: str = "host", domain: str = "domain") -> DataFrame:
    """Rows of df with each domain that the host is, or has behind a dot anywhere in it; one row a domain, without a shuffle of its own.

    A domain's first label has to be a whole label of the host if the domain has another, so that is
    an equi-join on labels; a domain of one label may begin any later label, so it is joined by prefixes, of the
    lengths that such domains have (a few numbers on the driver). df may be a stream; domains are a table.
    """
    wanted = domains.where(not_empty(F.col(domain))).select(F.col(domain).alias("_domain")).distinct()
    several = F.contains("_domain", F.lit("."))
    keyed = wanted.select("_domain", F.struct(several.alias("more"), F.split_part("_domain", F.lit("."), F.lit(1)).alias("key")).alias("_key"))
    lengths = sorted(r[0] for r in wanted.where(~several).select(F.length("_domain")).distinct().collect())
    name, labels = F.col(host), F.split(F.col(host), r"\.")
    whole = F.transform(labels, lambda x: F.struct(F.lit(True).alias("more"), x.alias("key")))
    tries = [F.array_distinct(whole)]
    if lengths:
        later = F.slice(labels, 2, F.greatest(F.size(labels) - 1, F.lit(0)))
        begun = F.flatten(F.transform(later, lambda x: F.filter(F.transform(F.array(*map(F.lit, lengths)), lambda n: F.when(n <= F.length(x), F.left(x, n))), lambda y: y.isNotNull())))
        starts = F.concat(begun, F.when(F.contains(name, F.lit(".")), F.array().cast("array<string>")).otherwise(F.array(name)))
        tries.append(F.transform(F.array_distinct(starts), lambda x: F.struct(F.lit(False).alias("more"), x.alias("key"))))
    placed = df.where(not_empty(name)).withColumn("_key", F.explode(F.concat(*tries)))
    fits = ~F.col("_key.more") | (name == F.col("_domain")) | F.contains(name, F.concat(F.lit("."), F.col("_domain")))
    return placed.join(keyed, "_key").where(fits).drop("_key").withColumnRenamed("_domain", domain)


def contains_pairs(hosts: DataFrame, domains: DataFrame, host: str = "host", domain: str = "domain") -> DataFrame:
    """Distinct (host, domain) where the host is the domain or has '.' + domain anywhere in it; see match_contained()."""
    return match_contained(hosts.select(host).distinct(), domains, host, domain)


def not_allowed(df: DataFrame, allowlist: DataFrame, host: str = "host") -> DataFrame:
    """Rows whose host isn't in the allowlist (host), whatever the case; an empty list keeps all, as do null hosts."""
    return df.join(allowlist.select(F.lower(F.col(allowlist.columns[0])).alias("_allowed")).distinct(), F.lower(F.col(host)) == F.col("_allowed"), "left_anti")


def latest_row(df: DataFrame, keys: list[str], ts: str, tiebreak: str) -> DataFrame:
    """The latest row of each group with first_seen, last_seen and event_count; of equal times the greatest tiebreak's."""
    rest = [c for c in df.columns if c not in keys]
    best = F.max(F.struct(F.col(ts).alias("_ts"), F.col(tiebreak).alias("_tie"), *(F.col(c) for c in rest))).alias("_best")
    grouped = df.groupBy(*keys).agg(F.min(ts).alias("first_seen"), F.count(F.lit(1)).alias("event_count"), best)
    return grouped.select(*keys, *(F.col(f"_best.{c}").alias(c) for c in rest), "first_seen", F.col("_best._ts").alias("last_seen"), "event_count")
