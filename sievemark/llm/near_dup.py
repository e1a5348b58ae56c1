"""Near-duplicate documents by circulant MinHash, with exact verification.

A document's set holds its distinct shingles of five words, as 64-bit hashes; shorter documents are one shingle. A first
permutation puts the shingles into a universe of 2**32 places. One second permutation gives all coordinates of the signature:
for coordinate k it is shifted circularly by k places, and the coordinate is the least image of the set. Bands of the
signature name buckets; documents that share a bucket are candidates.

Links hold where the exact Jaccard similarity of the full sets reaches the threshold. Documents with equal sets are one class
from the start, represented once. In every bucket all classes are compared with the bucket's smallest one, which settles
buckets of copies with as many comparisons as members. Buckets that still span several components are settled in two ways:
small ones by comparing their members across components, and the members of large ones by an exact set join with prefix and
positional filters. So no bucket is capped, and no pair that shares one is left out unless its ends are already connected.

Defined results. Null and empty texts, or texts without words, have an empty set, link with nothing and are their own
component, unless their doc_id has other texts. Rows with a null doc_id take no part: component_id null, kept true. Repeated rows
get equal results; rows with one doc_id and several texts belong to one component, as the doc_id does: their classes are linked.
Ties go to the smaller doc_id. Other columns are not read.

At scale: what is shuffled is a signature for each document (bands, not texts), and shingle sets of candidates only. Buckets
are aggregated before they are joined; large ones, of which there are BROADCAST_ROWS at most, have their heads broadcast, so
that no task gets a whole bucket. The sets of many classes meet the set of one head in tasks of PAIRS pairs. With 24 bands of 4, a pair at
0.85 shares a bucket but for a chance of 2e-8. Components come from repeated joins of links and labels on the cluster.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

SHINGLE, PERCENT = 5, 85
#: Rows of a band, and bands.
BANDING = (4, 24)
SMALL_BUCKET, BROADCAST_IDS = 32, 1_000_000
#: Members from which a bucket counts as large, large buckets at most, and pairs with one set that a task compares, in expectation.
LARGE_BUCKET, BROADCAST_ROWS, PAIRS = 4096, 100_000, 16_384
#: Shingles that are permuted at a time.
BLOCK = 1 << 19
_A, _B = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)  # constants of a public 64-bit finaliser
_C, _D = np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35)  # and of its 32-bit form


def _mix64(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * _A
    x ^= x >> np.uint64(33)
    x *= _B
    x ^= x >> np.uint64(33)
    return x


def _mix32(x: np.ndarray) -> np.ndarray:
    """A permutation of the numbers below 2**32, in place."""
    x ^= x >> np.uint32(16)
    x *= _C
    x ^= x >> np.uint32(13)
    x *= _D
    x ^= x >> np.uint32(16)
    return x


def shingle_set(text: str | None) -> np.ndarray:
    """The distinct shingles of a text, as ascending 64-bit hashes."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(SHINGLE, len(words))
    s = np.full(len(words) - size + 1, size, np.uint64)
    for j in range(size):
        s = _mix64(s * np.uint64(0x9E3779B97F4A7C15) + h[j : len(h) - size + 1 + j])
    return np.unique(s)


def signatures(sets: list[np.ndarray], rows: int, bands: int) -> np.ndarray:
    """Band hashes (one row for each set, none of them empty; one column for each band) as signed 64-bit integers."""
    out = np.empty((len(sets), bands), np.int64)
    start = 0
    while start < len(sets):
        end, total = start, 0
        while end < len(sets) and (end == start or total + len(sets[end]) <= BLOCK):
            total += len(sets[end])
            end += 1
        sizes = np.array([len(s) for s in sets[start:end]])
        first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        place = (_mix64(np.concatenate(sets[start:end])) >> np.uint64(32)).astype(np.uint32)
        for b in range(bands):
            band = np.full(end - start, b + 1, np.uint64)
            for r in range(rows):
                shifted = place + np.uint32(b * rows + r)
                band = _mix64(band * np.uint64(0x9E3779B97F4A7C15) + np.minimum.reduceat(_mix32(shifted), first))
            out[start:end, b] = band.view(np.int64)
        start = end
    return out


def sign(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, f (fingerprint of the set; null if empty), bands of every row."""
    rows, bands = BANDING

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                sets = [shingle_set(t.as_py()) for t in part.column(1)]
                full = [i for i, s in enumerate(sets) if len(s)]
                hashes: list = [None] * len(sets)
                if full:
                    for i, h in zip(full, signatures([sets[i] for i in full], rows, bands), strict=True):
                        hashes[i] = h
                prints = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(prints, pa.binary()), pa.array(hashes, pa.list_(pa.int64()))], ["doc_id", "n_shingles", "f", "bands"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_shingles long, f binary, bands array<long>")


def candidate_sets(docs: DataFrame, wanted: DataFrame, repeats: bool) -> DataFrame:
    """f, n, s (the set) of the wanted classes (f, id), from the texts of the documents that represent them. repeats: whether doc_ids occur in several rows."""
    ids = wanted.select(F.col("id").alias("_id"), F.col("f").alias("_f")).distinct()
    few = ids.count() <= BROADCAST_IDS
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(ids) if few else ids, F.col("doc_id") == F.col("_id")).select("_f", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                made = [(shingle_set(t.as_py()), f) for f, t in zip(part.column(0).to_pylist(), part.column(1), strict=True)]
                sets = [(s, f) for s, f in made if len(s) and xxhash.xxh3_128_digest(s.tobytes()) == f]  # other texts under the same doc_id are other classes
                yield pa.RecordBatch.from_arrays([pa.array([f for _, f in sets], pa.binary()), pa.array([len(s) for s, _ in sets], pa.int64()), pa.array([s.view(np.int64) for s, _ in sets], pa.list_(pa.int64()))], ["f", "n", "s"])

    made = texts.mapInArrow(run, "f binary, n long, s array<long>")
    return made.dropDuplicates(["f"]) if repeats else made


def _met(pairs: DataFrame, sets: DataFrame, value: str) -> DataFrame:
    """pairs (a, b), with the given column and n of both sets. b may be the same in many pairs: its set is sent once for each PAIRS of them."""
    salts = max(1, -(-pairs.count() // PAIRS))
    pairs = pairs.withColumn("salt", F.pmod(F.xxhash64("a", F.lit(3)), F.lit(salts)))
    one = sets.select(F.col("f").alias("a"), F.col(value).alias("sa"), F.col("n").alias("na"))
    two = pairs.select("b", "salt").distinct().join(sets.select(F.col("f").alias("b"), F.col(value).alias("sb"), F.col("n").alias("nb")), "b")
    return pairs.join(one, "a").join(two, ["b", "salt"])


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough. pairs: a written table.

    Most candidates are far apart. Sixteen bits of each shingle are compared first: sets cannot share more shingles than such
    ends, and as many more as either set loses by equal ends. Only pairs that pass this bound have their whole sets compared."""
    enough = lambda shared: 100 * shared >= percent * (F.col("na") + F.col("nb") - shared)
    ends = sets.select("f", "n", F.transform("s", lambda x: (x.bitwiseAND(F.lit(0xFFFF)) - 0x8000).cast("short")).alias("e"))
    lost = F.least(F.col("na") - F.size(F.array_distinct("sa")), F.col("nb") - F.size(F.array_distinct("sb")))
    near = _met(pairs, ends, "e").where(enough(F.size(F.array_intersect("sa", "sb")) + lost)).select("a", "b")
    return _met(written(near, "near"), sets, "s").where(enough(F.size(F.array_intersect("sa", "sb")))).select("a", "b")


def buckets_of(classes: DataFrame) -> DataFrame:
    """bucket, members, f, id, n of all classes that share a bucket with another, with the bucket's smallest class as cf, cn; a written table. classes: f, id, n, bands, written."""
    banded = classes.select("f", "id", "n", F.explode("bands").alias("bucket"))
    heads = banded.groupBy("bucket").agg(F.count("*").alias("members"), F.min(F.struct("id", "f", "n")).alias("head")).where("members > 1")
    heads = written(heads.select("bucket", "members", F.col("head.f").alias("cf"), F.col("head.n").alias("cn")), "buckets")
    large = F.col("members") > max(LARGE_BUCKET, classes.count() * BANDING[1] // BROADCAST_ROWS)
    hot = written(heads.where(large), "large-buckets")
    columns = ["bucket", "members", "f", "id", "n", "cf", "cn"]
    few = banded.join(F.broadcast(hot.select("bucket")), "bucket", "left_anti").join(heads.where(~large), "bucket").select(columns)
    return written(few.unionByName(banded.join(F.broadcast(hot), "bucket").select(columns)), "members")


def _alike(a: str, b: str, percent: int):
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def components(links: DataFrame, ids: DataFrame) -> DataFrame:
    """f, label: the smallest id of its component, of every class that a link touches. ids: f, id."""
    edges = written(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = written(edges.select(F.col("a").alias("f")).distinct().join(ids, "f").select("f", "id", F.col("id").alias("label")), "labels")
    while True:
        near = edges.join(labels.select(F.col("f").alias("b"), "label"), "b").select(F.col("a").alias("f"), "label")
        least = near.groupBy("f").agg(F.min("label").alias("near"))
        stepped = written(labels.join(least, "f").select("f", "id", F.least("label", "near").alias("label"), F.col("label").alias("old")), "stepped")
        heads = written(stepped.groupBy(F.col("id").alias("label")).agg(F.min("label").alias("further")), "heads")
        jumped = stepped.join(heads, "label", "left").select("f", "id", F.least("label", F.coalesce("further", "label")).alias("label"), "old")
        jumped = written(jumped, "labels")
        labels = jumped.select("f", "id", "label")
        if jumped.where("label != old").isEmpty():
            return labels.select("f", "label")


def _unsettled(members: DataFrame, labels: DataFrame) -> DataFrame:
    """The members of buckets that span several components, with their label and the number of members."""
    named = written(members.join(labels, "f", "left").withColumn("label", F.coalesce("label", "id")), "named")
    open_ = named.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low != high").select("bucket")
    return written(named.join(written(open_, "open"), "bucket", "left_semi"), "unsettled")


def link_classes(docs: DataFrame, classes: DataFrame, percent: int = PERCENT, repeats: bool = True) -> tuple[DataFrame, DataFrame | None]:
    """All classes' ids, and f, label of those that have links (None without candidates). classes: f, id, n, bands."""
    ids = classes.select("f", "id")
    shared = buckets_of(classes)
    members = shared.where(_alike("n", "cn", percent))
    wanted = written(members.select("f", "id").distinct(), "wanted")
    if wanted.isEmpty():
        return ids, None
    sets = written(candidate_sets(docs, wanted, repeats), "sets")
    links, labels = _settled(members, sets, ids, None, percent)
    rest = _unsettled(shared.select("bucket", "f", "id", "n", "members"), labels)
    links, labels, rest = _small(rest, sets, ids, links, labels, percent, docs, repeats)
    if rest is not None:
        missing = written(rest.select("f", "id").distinct().join(sets.select("f"), "f", "left_anti"), "missing")  # those unlike every head
        if not missing.isEmpty():
            sets = written(sets.unionByName(candidate_sets(docs, missing, repeats)), "sets")
        new = written(verified(written(prefix_pairs(rest, sets, percent), "probed"), sets, percent), "exact")
        if not new.isEmpty():
            links, labels = _joined(new, ids, links)
    return ids, labels


def prefix_pairs(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """All pairs (a, b) of members in different components that can reach the threshold, by prefix and positional filter.

    With shingles ordered by rarity among the members, sets of sizes m <= n that are similar enough have their first common
    shingle at a place p of the one and q of the other with min(m - p, n - q) no less than the overlap they need. It lies in
    the first 15 % of the larger set and the first 8 % of the smaller. Members of a group of copies that differ more than that
    have only shingles of their own there, and so meet nobody.
    """
    reach = F.greatest(F.col("n") - F.ceil(F.col("n") * percent / 100) + 1, F.lit(1))
    active = members.select("f", "n", "label").distinct().withColumn("reach", reach.cast("int"))
    tokens = sets.join(active.select("f"), "f", "left_semi").select("f", F.explode("s").alias("token"))
    counted = written(tokens.groupBy("token").agg(F.count("*").alias("often"), F.min("f").alias("only")), "tokens")
    # tokens that one set alone has come first in its order and meet nobody: a set with a prefix of such tokens is settled
    alone = counted.where("often = 1").groupBy(F.col("only").alias("f")).agg(F.count("*").cast("int").alias("alone"))
    live = active.join(alone, "f", "left").withColumn("alone", F.coalesce("alone", F.lit(0))).where("alone < reach")
    live = written(live, "live")
    shared = sets.join(live.select("f"), "f", "left_semi").select("f", F.explode("s").alias("token"))
    ordered = shared.join(counted.where("often > 1").select("token", "often"), "token").groupBy("f").agg(F.array_sort(F.collect_list(F.struct("often", "token"))).alias("o"))
    first = F.slice("o", F.lit(1), F.col("reach") - F.col("alone"))
    probes = live.join(ordered, "f").select("f", "n", "label", "alone", F.posexplode(first).alias("p", "x")).select("f", "n", "label", (F.col("alone") + F.col("p")).alias("p"), F.col("x.token").alias("token"))
    probes = written(probes, "prefixes")
    needed = lambda m, n: F.ceil((m + n) * percent / (100 + percent))
    small = probes.where(F.col("p") <= F.col("n") - needed(F.col("n"), F.col("n"))).select("token", F.col("f").alias("a"), F.col("n").alias("m"), F.col("label").alias("l"), F.col("p").alias("q"))
    both = small.join(probes.withColumnRenamed("f", "b"), "token").where((F.struct("m", "a") < F.struct("n", "b")) & (F.col("l") != F.col("label")) & _alike("m", "n", percent))
    return both.where(F.least(F.col("m") - F.col("q"), F.col("n") - F.col("p")) >= needed(F.col("m"), F.col("n"))).select("a", "b").distinct()


def _settled(members: DataFrame, sets: DataFrame, ids: DataFrame, links: DataFrame | None, percent: int) -> tuple[DataFrame, DataFrame]:
    """Compares all members with the head of their bucket; returns all links so far, and labels."""
    pairs = written(members.where("f != cf").select(F.col("f").alias("a"), F.col("cf").alias("b")).distinct(), "pairs")
    return _joined(verified(pairs, sets, percent), ids, links)


def _joined(new: DataFrame, ids: DataFrame, links: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    links = written(new if links is None else links.unionByName(new), "links")
    return links, components(links, ids)


def _small(rest: DataFrame, sets: DataFrame, ids: DataFrame, links: DataFrame, labels: DataFrame, percent: int, docs: DataFrame, repeats: bool) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Compares the members of small unsettled buckets across components; returns what remains in large ones."""
    few = rest.where(F.col("members") <= SMALL_BUCKET)
    other = few.select("bucket", F.col("f").alias("b"), F.col("id").alias("id2"), F.col("n").alias("n2"), F.col("label").alias("label2"))
    across = few.join(other, "bucket").where((F.struct("id", "f") < F.struct("id2", "b")) & (F.col("label") != F.col("label2")) & _alike("n", "n2", percent))
    pairs = written(across.select(F.col("f").alias("a"), "b").distinct(), "pairs")
    if not pairs.isEmpty():
        need = pairs.select(F.col("a").alias("f")).unionByName(pairs.select(F.col("b").alias("f"))).distinct().join(ids, "f")
        missing = written(need.join(sets.select("f"), "f", "left_anti"), "missing")
        if not missing.isEmpty():
            sets = sets.unionByName(candidate_sets(docs, missing, repeats))
        new = written(verified(pairs, sets, percent), "across")
        if not new.isEmpty():
            links, labels = _joined(new, ids, links)
    large = written(rest.where(F.col("members") > SMALL_BUCKET), "large")
    return links, labels, None if large.isEmpty() else _or_none(_unsettled(large.drop("label"), labels))


def _or_none(df: DataFrame) -> DataFrame | None:
    return None if df.isEmpty() else df


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row."""
    docs = docs.select("doc_id", "text")
    signed = written(sign(docs), "signed")
    linked = signed.where(F.col("doc_id").isNotNull() & F.col("f").isNotNull())
    classes = written(linked.groupBy("f").agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")), "classes")
    # classes that a doc_id has in common
    several = linked.groupBy("doc_id").agg(F.count("*").alias("k"), F.min("f").alias("least"), F.max("f").alias("most")).where("k > 1")
    several = written(several, "several")
    mixed = several.where("least != most").select("doc_id", "least")
    ids, labels = link_classes(docs, classes, percent, not several.isEmpty())
    named = ids.withColumn("label", F.col("id")) if labels is None else ids.join(labels, "f", "left").withColumn("label", F.coalesce("label", "id"))
    named = written(named.select("f", "label"), "named")
    per_doc = None
    if not mixed.isEmpty():
        own = linked.select("doc_id", "f").join(mixed, "doc_id").select("doc_id", "f").distinct()
        named, per_doc = _of_one_document(own, named)
    out = signed.select("doc_id", "n_shingles", "f").join(named, "f", "left")
    if per_doc is not None:  # rows without words of a doc_id that has other texts
        out = out.join(per_doc, "doc_id", "left").withColumn("label", F.coalesce("label", "doc_label"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def _of_one_document(own: DataFrame, named: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Labels with the components joined that documents with several texts have in common, and doc_id, doc_label of these. own: doc_id, f."""
    held = written(own.join(named, "f").select("doc_id", "label").distinct(), "held")
    least = held.groupBy("doc_id").agg(F.min("label").alias("least"))
    links = held.join(least, "doc_id").where("label != least").select(F.col("label").alias("a"), F.col("least").alias("b"))
    joined = components(links, links.select(F.col("a").alias("f")).unionByName(links.select(F.col("b").alias("f"))).distinct().withColumn("id", F.col("f")))
    joined = written(joined.select(F.col("f").alias("old"), F.col("label").alias("new")), "joined")
    again = lambda d: d.join(joined, d["label"] == joined["old"], "left").withColumn("label", F.coalesce("new", "label")).drop("old", "new")
    return written(again(named), "named"), written(again(held).select("doc_id", F.col("label").alias("doc_label")).distinct(), "documents")


def one_of_each(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of docs, all columns, whose document is the smallest of its component."""
    gone = written(near_duplicates(docs, percent).where("not kept").select(F.col("doc_id").alias("gone_id")).distinct(), "gone")
    return docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")
