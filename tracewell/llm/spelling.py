"""Spelling variants: words of one edit's distance, by a frontier of states that descends a trie.

A trie of all words is a table of its edges, each node with its children and their next symbols. A state
(word, position, node, edits) says that the word's symbols before the position spell the node with so
many edits. Level by level the states at nodes of one depth are joined with these nodes: a state
without an edit stands on its own word's path and puts in, leaves out or replaces a symbol, a state
with one follows its word's next symbol. A state at its word's end on a node that ends a word is a
neighbour. States whose next symbol the node's child hasn't are never made.

An edit leaves the first or the second half of a word alone. So words are put into the trie forwards
and backwards, and edits begin after that half, at nodes of few children, not at the root.

Words of LEVELS symbols or more are compared by the words that one deletion makes of them, by 128-bit hashes: a
word that long takes a row for each of its symbols, not a level.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.llm.common import stage

#: Fixed value: a word is a run of these letters.
LETTERS = re.compile("[A-Za-zÀ-ÿ]+")
#: Words that a task counts before it sends them on.
COUNTED = 200_000
#: Words of fewer symbols are in the trie, which has so many levels at most.
LEVELS = 32
#: First symbols of words spelled forwards and backwards, and the symbol after a word; none of them is a letter.
FORWARDS, BACKWARDS, END = ">", "<", "."


def mangled(run: str, doc: bytes, every: int | None) -> str:
    """The run, or the run without one symbol if its checksum with the document's id says so."""
    if every is None or (h := zlib.crc32(run.encode(), zlib.crc32(doc))) % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def words(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", least_symbols: int = 6, least_n: int = 5, drop_every: int | None = None) -> DataFrame:
    """(word, n): runs of letters of all texts, ASCII capitals as small letters, of at least so many symbols and occurrences.

    drop_every: a run whose CRC-32, of "<doc_id>:<run>", is a multiple of it loses one symbol, for tests of the
    grouping on spoilt text. Null and empty texts have no words; a null doc_id is written as ''; repeated rows count each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for doc, value in zip(batch.column("doc").to_pylist(), batch.column("text"), strict=True):
                if not value.is_valid:
                    continue
                own = Counter(LETTERS.findall(value.as_py().encode().lower().decode()))  # bytes fold ASCII only
                name = f"{doc}:".encode()
                for word, n in own.items():
                    if len(word) >= least_symbols and len(word := mangled(word, name, drop_every)) >= least_symbols:
                        counts[word] += n
                if len(counts) > COUNTED:
                    yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
                    counts.clear()
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    rows = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("doc"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_n)


def symbol(spelled: Column | str, at: Column) -> Column:
    """The symbol at a place from 0; '' beyond the end."""
    return F.substr(spelled, at + 1, F.lit(1))


def trie(entries: DataFrame) -> DataFrame:
    """(depth, node, children) of every node that an edit can reach; children: (symbol, next), next having the child's own symbols.

    entries: spelled, which ends with END, and `free`, the symbols before the first edit. A node is the text that leads to it.
    """
    least = entries.agg(F.min("free")).first()[0] or 1
    places = F.sequence(F.lit(least), F.length("spelled") - 1)
    edges = entries.select(F.explode(F.transform(places, lambda i: F.struct(F.substr("spelled", F.lit(1), i).alias("node"), symbol("spelled", i).alias("symbol")))).alias("e")).select("e.*").distinct()
    edges = stage(edges, "edges")
    after = edges.groupBy(F.col("node").alias("child")).agg(F.array_join(F.collect_set("symbol"), "").alias("next"))
    full = edges.withColumn("child", F.concat("node", "symbol")).join(after, "child", "left")
    nodes = full.groupBy("node").agg(F.collect_list(F.struct("symbol", F.coalesce("next", F.lit("")).alias("next"))).alias("children"))
    # In ranges of depth, so that a level reads its own files only.
    return stage(nodes.select(F.length("node").alias("depth"), "node", "children").repartitionByRange("depth", "node"), "trie")


def step(states: DataFrame, nodes: DataFrame) -> DataFrame:
    """(spelled, at, node, edits, done) one level below states (spelled, at, node, edits); done: node is a neighbour."""
    at, t, child, after = F.col("at"), F.col("spelled"), F.col("c.symbol"), F.col("c.next")
    size = F.length("spelled") - 1
    here = symbol(t, at)
    # Where the word goes on after the child's symbol, for each edit that is possible.
    replaced = F.when((child != END) & (at < size) & (child != here), at + 1)
    put_in = F.when((child != END) & (child != here), at)
    # Of a run of equal symbols only the last is left out, as a symbol is put in only behind equal ones.
    left_out = F.when((at < size) & (here != symbol(t, at + 1)) & (child == symbol(t, at + 1)), at + 2)
    follows = F.when(child == here, at + 1)
    moves = F.when(F.col("edits") == 0, F.array(replaced, put_in, left_out)).otherwise(F.array(follows))
    moved = states.join(nodes.select("node", "children"), "node").select("spelled", "at", "node", "edits", F.explode("children").alias("c")).select("spelled", "node", F.explode(F.array_compact(moves)).alias("to"), child.alias("symbol"), after.alias("next"))
    # END as the child's symbol stays at the node, which is a word; else the child has to have what comes next.
    ends = F.col("symbol") == END
    fits = F.when(ends, F.col("to") == size + 1).otherwise(F.contains("next", symbol(t, F.col("to"))))
    node = F.when(ends, F.col("node")).otherwise(F.concat("node", "symbol"))
    return moved.where(fits).select("spelled", F.col("to").alias("at"), node.alias("node"), F.lit(1).alias("edits"), (ends | (F.col("to") == size)).alias("done"))


def trie_neighbours(vocabulary: DataFrame) -> DataFrame:
    """(word, near) of words of fewer than LEVELS symbols; each pair both ways, and perhaps more than once."""
    half = F.floor(F.length("word") / 2).cast("int")
    ways = F.array(F.struct(F.concat(F.lit(FORWARDS), "word", F.lit(END)).alias("spelled"), (half + 1).alias("free")), F.struct(F.concat(F.lit(BACKWARDS), F.reverse("word"), F.lit(END)).alias("spelled"), (F.length("word") - half + 1).alias("free")))
    entries = stage(vocabulary.where(F.length("word") < LEVELS).select(F.explode(ways).alias("e")).select("e.*"), "spelled")
    nodes = trie(entries)
    first, last = nodes.agg(F.min("depth"), F.max("depth")).first()
    found, frontier = [], None
    for depth in range(first or 0, (last or -1) + 1):
        begun = entries.where((F.col("free") <= depth) & (F.length("spelled") > depth)).select("spelled", F.lit(depth).alias("at"), F.substr("spelled", F.lit(1), F.lit(depth)).alias("node"), F.lit(0).alias("edits"))
        states = begun if frontier is None else begun.unionByName(frontier)
        moved = stage(step(states, nodes.where(F.col("depth") == depth)), f"level-{depth}")
        found.append(moved.where("done").select("spelled", "node"))
        frontier = moved.where("NOT done").select("spelled", "at", "node", "edits")
    if not found:
        return vocabulary.select("word", F.col("word").alias("near")).where("false")
    pairs = reduce(DataFrame.unionByName, found)
    plain = lambda c: F.when(F.startswith(c, F.lit(FORWARDS)), F.substr(c, F.lit(2))).otherwise(F.reverse(F.substr(c, F.lit(2))))
    return pairs.select(plain(F.rtrim(F.col("spelled"), F.lit(END))).alias("word"), plain(F.col("node")).alias("near"))


def long_neighbours(vocabulary: DataFrame) -> DataFrame:
    """(word, near) of words of LEVELS - 1 symbols or more; each pair both ways, and perhaps more than once.

    Words that lose the same symbols to a deletion at one place differ there only, so a group has as many words as there are letters at most.
    """
    long = vocabulary.where(F.length("word") >= LEVELS - 1).select("word")
    name = lambda c: F.unhex(F.md5(c))
    size = F.length("word")
    cut = F.concat(F.substr("word", F.lit(1), F.col("at")), F.substr("word", F.col("at") + 2))
    made = stage(long.select("word", F.explode(F.sequence(F.lit(0), size - 1)).alias("at")).select(name(F.col("word")).alias("key"), "at", name(cut).alias("rest")), "deletions")
    other = made.select(F.col("key").alias("other"), "at", "rest")
    replaced = made.join(other, ["at", "rest"]).where("key <> other").select("key", "other")
    whole = long.select(name(F.col("word")).alias("rest"))
    left_out = made.join(whole, "rest").select("key", F.col("rest").alias("other"))
    pairs = replaced.unionByName(left_out).unionByName(left_out.select(F.col("other").alias("key"), F.col("key").alias("other"))).distinct()
    named = lambda key, word: long.select(name(F.col("word")).alias(key), F.col("word").alias(word))
    return pairs.join(named("key", "word"), "key").join(named("other", "near"), "other").select("word", "near")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last form of each word of forms (word, form).

    A form has a multiple of its word's n, so a chain is of a few tens of words at most; each round follows twice as many steps.
    """
    current = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = current.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if current.join(further, "root", "left_semi").isEmpty():
            return current
        current = stage(current.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")


def variants(vocabulary: DataFrame, ratio: int = 5) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each word of a vocabulary (word, n), whose words are distinct and not null.

    Two words are near if one symbol put in, left out or replaced makes one of the other. A word's form is
    its near word of largest n, of equals the least by code points, if that n is at least `ratio` times the word's own;
    root is the last of the word's forms, the word itself if it has none. A word has any number of near words. An empty
    vocabulary gives an empty table; other columns are left out.
    """
    known = stage(vocabulary.select("word", F.col("n").cast("bigint").alias("n")), "vocabulary")
    near = trie_neighbours(known).unionByName(long_neighbours(known)).distinct()
    counted = near.join(known.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = counted.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("down"), "near")).alias("best"))
    joined = known.join(best, "word", "left")
    takes = -F.col("best.down") >= F.lit(ratio) * F.col("n")
    formed = stage(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(takes, F.col("best.near")).alias("form"), F.when(takes, -F.col("best.down")).alias("form_n")), "forms")
    last = roots(formed.where("form IS NOT NULL"))
    return formed.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
