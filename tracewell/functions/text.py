"""Column functions that normalise hashes, hosts, patterns and texts; all built from Spark's own."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space that is trimmed: Unicode White_Space and the four separator controls.
SPACE = r"[\s\x1c-\x1f\x85]"


def clean(value: Column) -> Column:
    """Text without outer white space; null becomes ''."""
    return F.regexp_replace(F.coalesce(value.cast("string"), F.lit("")), rf"(?U)^{SPACE}+|{SPACE}+\z", "")


def blank(value: Column) -> Column:
    """A cell of a table: null becomes ''."""
    return F.coalesce(value.cast("string"), F.lit(""))


def valid_hash(value: Column, digits: int) -> Column:
    """The lower-case hash if the value is one of so many hex digits, else ''."""
    lowered = F.lower(clean(value))
    return F.when(lowered.rlike(rf"^[0-9a-f]{{{digits}}}\z"), lowered).otherwise(F.lit(""))


def strip_host(value: Column) -> Column:
    """Lower-case host of a pattern or URL: without scheme, path, port and final dots."""
    host = F.regexp_replace(F.lower(clean(value)), r"^[a-z][a-z0-9+.-]*://", "")
    host = F.regexp_replace(F.split_part(host, F.lit("/"), F.lit(1)), r":[0-9]+\z", "")
    return F.regexp_replace(host, r"\.+\z", "")


def domain_root(pattern: Column) -> Column:
    """Domain that a host pattern stands for: what follows a leading `*.`, the host itself if it has no
    glob, else its last two labels; '' for a glob of fewer."""
    host = strip_host(pattern)
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    last_two = F.when(F.size(labels) >= 2, F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), ".")).otherwise("")
    return F.when(host.startswith("*."), F.substring(host, 3, 1 << 30)).when(~host.rlike(r"[*\[{]"), host).otherwise(last_two)


def glob_regex(pattern: Column) -> Column:
    """Anchored regular expression of a host pattern: `*` matches anything, closed [..] and {..} stay, the rest is literal."""
    parts = F.regexp_extract_all(strip_host(pattern), F.lit(r"(?s)\[[^\]]*\]|\{[^}]*\}|."), F.lit(0))

    def part(x: Column) -> Column:
        return F.when(x == "*", F.lit(".*")).when(F.length(x) > 1, x).when(x.rlike(r"^[.+?()|^$\\\[{]$"), F.concat(F.lit("\\"), x)).otherwise(x)

    return F.concat(F.lit("^(?:"), F.array_join(F.transform(parts, part), ""), F.lit(")$"))


def url_host(url: Column, bare: bool = False) -> Column:
    """Lower-case host of a URL, null if there is none; bare: a text without a scheme is taken as a host."""
    host = F.lower(F.try_parse_url(url, F.lit("HOST")))
    return F.coalesce(host, F.nullif(strip_host(url), F.lit(""))) if bare else host


def unique_text(value: Column) -> Column:
    """Aggregate: distinct cleaned values without blanks, sorted by code point and joined by ';'."""
    return F.array_join(F.array_sort(F.collect_set(F.nullif(clean(value), F.lit("")))), ";")


def value_set(value: Column) -> Column:
    """Aggregate: sorted array of distinct values without nulls."""
    return F.array_sort(F.collect_set(value))


def not_empty(value: Column) -> Column:
    return value.isNotNull() & (value != "")
