"""Benchmark decontamination by a prefix-filtered set join, verified over item-sized windows.

Items are cut into windows of WINDOW words (shorter items are one window). A window that a document contains shares all its
shingles with it, so that one necessary prefix token is enough to find it: the window's shingle that is rarest in the corpus.
Shingles are ordered by their count over all documents; windows of which some shingle occurs nowhere drop out. Documents are
joined with the prefix tokens; a hit fixes where the window would begin, which has to lie inside the document together with
the window's length (the positional and the length bound), and the words there are compared one by one.

Defined results. Null text has no words. Null item texts, items without words and items with a null id have no windows.
Items that repeat an id count once. Repeated rows of documents are each returned; rows with equal doc_id and text get equal results. A null doc_id is an id like any other. Empty tables: no rows, or no hits. Other columns are not read.

At scale: DataFrame operations only. Documents are expanded to words inside one generated stage that looks each shingle up in
a table of prefix tokens, so that only hits are shuffled. The table is broadcast in blocks of BLOCK_BYTES bytes (of windows, not
of rows, since a word can be long), with a pass over the documents for each. A benchmark of more than MOST_BLOCKS blocks takes
a single pass instead: shingles that a bounded filter of SLOTS slots lets through are shuffled to their tokens, with the words
around them; tokens that occur often are broadcast by themselves. Spans of a document are gathered per document, ten to a word at most.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

WINDOW, SHINGLE = 10, 3
#: Bytes of a broadcast block, and what a row takes beside its window; blocks from which a single pass with a shuffle is taken.
BLOCK_BYTES, ROW_BYTES, MOST_BLOCKS = 64 << 20, 48, 4
#: Slots of the filter before that shuffle, and occurrences from which a token is broadcast by itself then.
SLOTS, OFTEN = 1 << 20, 65_536
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), SEPARATOR), "")


def _key(array: Column, start: Column, size: int) -> Column:
    """Hash of `size` words from a start that counts from 0."""
    return F.xxhash64(*(F.get(array, start + j) for j in range(size)))


def windows(benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct windows (window: its words joined by spaces, n: how many) and the items they come from (window, item_id)."""
    items = benchmark.where(F.col("item_id").isNotNull()).select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    size = F.least(F.size("w"), F.lit(WINDOW))
    cut = items.select("item_id", size.alias("n"), "w", F.explode(F.sequence(F.lit(1), F.size("w") - size + 1)).alias("start"))
    of = written(cut.select("item_id", "n", F.array_join(F.slice("w", F.col("start"), F.col("n")), " ").alias("window")).distinct(), "windows")
    return of.select("window", "n").distinct(), of.select("window", "item_id")


def _expanded(docs: DataFrame, end: bool) -> DataFrame:
    """doc_id, h, w (all words), i (from 0) for every word; with end also a last row for each document, where i is the number of words."""
    base = docs.select("doc_id", F.xxhash64("text").alias("h"), words(F.col("text")).alias("w"))
    return base.select("doc_id", "h", "w", F.posexplode(F.concat("w", F.array(F.lit(None).cast("string"))) if end else F.col("w")).alias("i", "word"))


def _looked_up(expanded: DataFrame, size: int) -> Column:
    """The shingle that begins at a word; null if the document ends before its end."""
    return F.when(F.col("i") + size <= F.size("w"), F.xxhash64("word", *(F.get("w", F.col("i") + j) for j in range(1, size))))


def prefix_tokens(docs: DataFrame, distinct: DataFrame) -> DataFrame:
    """window, n, size, key, offset: the rarest shingle of every window all of whose shingles occur, and where in the window it begins."""
    parts = distinct.select("window", "n", F.least("n", F.lit(SHINGLE)).alias("size"), F.split("window", " ").alias("w"))
    at = F.explode(F.sequence(F.lit(0), F.col("n") - F.col("size")))
    key = reduce(lambda a, k: F.when(F.col("size") == k, _key(F.col("w"), F.col("offset"), k)).otherwise(a), range(1, SHINGLE + 1), F.lit(None).cast("long"))
    shingles = written(parts.select("window", "n", "size", "w", at.alias("offset")).withColumn("key", key).drop("w"), "shingles")
    distinct_keys = written(shingles.select("size", "key").distinct(), "keys")
    counts = []
    for block, size, whole in _blocks(distinct_keys.withColumn("bytes", F.lit(ROW_BYTES))):
        expanded = _expanded(docs, end=False)
        keys = expanded.select(F.lit(size).alias("size"), _looked_up(expanded, size).alias("key")).where("key is not null")
        own = block.select("size", "key")
        if whole:  # counted before the join: one row for each distinct shingle that the filter lets through
            counts.append(_filtered(keys, own).groupBy("size", "key").agg(F.count("*").alias("n_corpus")).join(own, ["size", "key"], "left_semi"))
        else:
            counts.append(keys.join(F.broadcast(own), ["size", "key"], "left_semi").groupBy("size", "key").agg(F.count("*").alias("n_corpus")))
    none = shingles.where("false").select("window", "n", "size", "key", "offset", F.lit(0).cast("long").alias("n_corpus"))
    if not counts:
        return none
    corpus = written(reduce(DataFrame.unionByName, counts), "counts")
    known = shingles.join(corpus, ["size", "key"], "left")
    rarest = known.groupBy("window", "n", "size").agg(F.min(F.struct(F.coalesce("n_corpus", F.lit(0)).alias("n_corpus"), "offset", "key")).alias("rarest"))
    return rarest.where("rarest.n_corpus > 0").select("window", "n", "size", F.col("rarest.key").alias("key"), F.col("rarest.offset").alias("offset"), F.col("rarest.n_corpus").alias("n_corpus"))


def _filtered(keys: DataFrame, own: DataFrame) -> DataFrame:
    """The rows whose key falls into a slot that some key of own (a written table) falls into: SLOTS small rows at most are broadcast."""
    slot = lambda: F.pmod(F.xxhash64("key", F.lit(5)), F.lit(SLOTS))
    slots = own.select(slot().alias("slot")).distinct()
    return keys.withColumn("slot", slot()).join(F.broadcast(slots), "slot", "left_semi").drop("slot")


def _blocks(tokens: DataFrame) -> list[tuple[DataFrame, int, bool]]:
    """Parts of a table with columns size, key and bytes, with the shingle size of each: blocks of BLOCK_BYTES bytes in expectation, or (true) all rows where these would be too many blocks."""
    out = []
    for r in tokens.groupBy("size").agg(F.sum("bytes").alias("bytes")).orderBy("size").collect():  # at most SHINGLE rows
        blocks = -(-r["bytes"] // BLOCK_BYTES)
        own = tokens.where(F.col("size") == r["size"])
        if blocks > MOST_BLOCKS:
            out.append((own, r["size"], True))
        else:
            out += [(own if blocks == 1 else own.where(F.pmod(F.xxhash64("key"), F.lit(blocks)) == b), r["size"], False) for b in range(blocks)]
    return out


def _shuffled_hits(docs: DataFrame, tokens: DataFrame, size: int) -> DataFrame:
    """doc_id, h, span, window of all occurrences of windows, found by shuffling shingles with the words around them to their tokens."""
    expanded = _expanded(docs, end=False)
    first = F.greatest(F.col("i") - (WINDOW - size), F.lit(0))
    near = F.slice("w", first + 1, F.lit(2 * WINDOW - size))
    keys = expanded.select("doc_id", "h", "i", _looked_up(expanded, size).alias("key"), first.alias("first"), near.alias("near"))
    keys = _filtered(keys.where("key is not null"), tokens)
    often = written(tokens.where(F.col("n_corpus") > OFTEN), "often")
    by_key = lambda t: t.select("key", "window", "n", "offset", F.split("window", " ").alias("own"))
    # few tokens can occur often, as all words over OFTEN bound them; but one window's shingles may all be frequent, so that Spark weighs their size
    found = keys.join(by_key(often), "key").unionByName(keys.join(by_key(tokens.where(F.col("n_corpus") <= OFTEN)), "key"))
    start = F.col("i") - F.col("offset")
    holds = (start >= 0) & (F.slice("near", F.greatest(start - F.col("first") + 1, F.lit(1)), F.col("n")) == F.col("own"))
    return found.where(holds).select("doc_id", "h", F.struct(start.alias("start"), (start + F.col("n")).alias("end")).alias("span"), "window")


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every row, and h, the hash of its text."""
    docs = docs.select("doc_id", "text")
    distinct, items = windows(benchmark)
    tokens = written(prefix_tokens(docs, distinct), "tokens").withColumn("bytes", F.octet_length("window") + ROW_BYTES)
    found = []
    none = F.lit(None)
    no_words = none.cast("int")
    ends = _expanded(docs, end=True)
    blocks = _blocks(tokens)
    for block, size, whole in blocks:
        if whole:
            found.append(_shuffled_hits(docs, block, size).select("doc_id", "h", no_words.alias("n_words"), "span", "window"))
            continue
        first = not found and not any(w for *_, w in blocks)  # the first pass counts the words too
        expanded = ends if first else _expanded(docs, end=False)
        expanded = expanded.withColumn("token", _looked_up(expanded, size))
        small = block.select("key", "window", "n", "offset", F.split("window", " ").alias("own"))
        joined = expanded.join(F.broadcast(small), F.col("key") == F.col("token"), "left" if first else "inner")
        start = F.col("i") - F.col("offset")
        holds = (start >= 0) & (start + F.col("n") <= F.size("w")) & (F.slice("w", F.greatest(start + 1, F.lit(1)), F.col("n")) == F.col("own"))
        last = F.col("i") == F.size("w") if first else F.lit(False)
        hit = F.coalesce(holds, F.lit(False))
        kept = joined.where(last | hit)
        found.append(kept.select("doc_id", "h", F.when(last, F.size("w")).alias("n_words"), F.when(hit, F.struct(start.alias("start"), (start + F.col("n")).alias("end"))).alias("span"), F.when(hit, F.col("window")).alias("window")))
    if not found or any(w for *_, w in blocks):
        found.append(docs.select("doc_id", F.xxhash64("text").alias("h"), F.size(words(F.col("text"))).alias("n_words"), none.cast("struct<start:int,end:int>").alias("span"), none.cast("string").alias("window")))
    rows = reduce(DataFrame.unionByName, found)
    per = rows.groupBy("doc_id", "h").agg(F.count("n_words").alias("copies"), F.max("n_words").cast("long").alias("n_words"), F.array_sort(F.collect_set("span")).alias("spans"), F.collect_set("window").alias("held"))
    per = written(per, "hits")
    covered = F.aggregate("spans", F.struct(F.lit(0).alias("to"), F.lit(0).cast("long").alias("n")), lambda a, s: F.struct(F.greatest(a["to"], s["end"]).alias("to"), (a["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(a["to"], s["start"]))).alias("n")), lambda a: a["n"])
    held = per.where(F.size("held") > 0).select("doc_id", "h", F.explode("held").alias("window"))
    listed = held.join(items, "window").groupBy("doc_id", "h").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    listed = written(listed, "items").select(F.col("doc_id").alias("of"), F.col("h").alias("of_h"), "items")
    out = per.join(listed, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("h") == F.col("of_h")), "left")
    out = out.select("doc_id", "h", "n_words", covered.alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"), F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), "h")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs, all columns, that hold no benchmark window."""
    bad = written(contamination(docs, benchmark).where("contaminated").select(F.col("doc_id").alias("bad_id"), F.col("h").alias("bad_h")).distinct(), "contaminated")
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["bad_id"]) & (F.xxhash64(docs["text"]) == bad["bad_h"]), "left_anti")
