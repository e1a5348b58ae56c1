"""Removal of repeated byte strings over a whole corpus, by suffix arrays over shards.

A byte goes if a string of LENGTH bytes that covers it also starts earlier: in a document with a smaller id, or earlier in the
same one. Matches never cross documents, and strings are judged on the input.

Sharding. Every window of LENGTH bytes has an anchor: the 32 bytes in it whose hash is least (the leftmost such). Equal windows
have equal anchors at equal places, so that all copies of a window meet in the shard of its anchor. Neighbouring windows with
the same anchor form a context, and a context is all that is known of them outside their document. Contexts that are equal as
a whole (by a 128-bit cryptographic digest, and by their bytes wherever these travel along) are a class: its first member
stands for it, the others go. Anchors that have a single class are done. The other classes have the bytes of their first
member fetched. An anchor with more than SPLIT_BYTES of them is split: its contexts are halved by their windows, which share
more bytes and so have longer anchors, and form classes anew. In each shard windows without a partner are left out, equal stretches
of the rest are classes, and the suffix array of one of each is built; windows that are equal stand in a row there, and all but the first in document
order go.

Defined results. Null text is empty; texts shorter than LENGTH lose nothing. Rows with a null doc_id take no part and lose
nothing. Rows that repeat a doc_id and text count as one document, and each is returned with the same result; one doc_id with
several texts is several documents, in order of a hash of the text. Other columns are not read.

At scale: what is shuffled of every document is its anchors, about one for 35 bytes; in a task equal contexts are merged before.
Anchors that a bounded sample of documents finds often are dealt by class and a salt instead of by anchor, in two steps, so
that neither a common passage nor a large group of copies meets in one task; the sample decides only where rows are compared,
never what is removed. Tasks stream through sorted rows and hold one shard at a time. The texts themselves are shuffled to
fetch contexts and to cut.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import process_slots, written
from .suffix_array import suffix_array

LENGTH, ANCHOR = 100, 32
#: Bytes of contexts that a shard holds, and beyond which an anchor is split; windows whose anchors are sought at a time.
SHARD_BYTES, SPLIT_BYTES, BLOCK = 1 << 17, 1 << 15, 1 << 19
#: Documents, in expectation, that are sampled for common anchors; rows in the sample that make an anchor common; tasks that a class of a common anchor is dealt over at first.
SAMPLE_DOCS, COMMON, SALTS = 20_000, 64, 32
_SPAN = LENGTH - ANCHOR + 1
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_LOW = _U((1 << 20) - 1)
_TABLE: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A number for every byte value, and the powers of the base and of its inverse modulo 2**64."""
    global _TABLE
    if _TABLE is None:
        size = BLOCK + 4 * LENGTH
        values = np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 63, 256, dtype=np.uint64)
        with np.errstate(over="ignore"):
            powers = np.cumprod(np.concatenate([[_U(1)], np.full(size, _U(_BASE))]), dtype=np.uint64)
            inverse = np.cumprod(np.concatenate([[_U(1)], np.full(size, _U(pow(_BASE, -1, 1 << 64)))]), dtype=np.uint64)
        _TABLE = values, powers, inverse
    return _TABLE


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    return x ^ (x >> _U(32))


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    step = 1
    m = x
    while 2 * step <= width:
        m = np.minimum(m[:-step], m[step:])
        step *= 2
    rest = width - step
    return np.minimum(m[: len(m) - rest], m[rest:]) if rest else m


class Hashes:
    """Hashes of any part of a byte array of BLOCK + 4 * LENGTH bytes at most."""

    def __init__(self, data: np.ndarray):
        values, powers, self.inverse = _tables()
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(values[data] * powers[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[start]) * self.inverse[start])


def contexts(data: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchor hash, first window, last window and anchor of the contexts of a byte array; valid: the windows that count."""
    n = len(data) - LENGTH + 1
    starts = np.arange(len(data) - ANCHOR + 1)
    grams = Hashes(data).of(starts, starts + ANCHOR)
    anchor = (_sliding_min(grams & ~_LOW | starts.astype(np.uint64), _SPAN) & _LOW).astype(np.int64)[:n]
    new = np.ones(n, bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | ~valid[:-1]
    new &= valid
    first = np.flatnonzero(new)
    ends = np.ones(n, bool)
    ends[:-1] = new[1:] | ~valid[1:]
    last = np.flatnonzero(ends & valid)
    return grams[anchor[first]].view(np.int64), first, last, anchor[first]


def _digests(parts: Iterable[bytes]) -> np.ndarray:
    """128-bit digests, as two integers each."""
    return np.frombuffer(b"".join(hashlib.blake2b(p, digest_size=16).digest() for p in parts), np.int64).reshape(-1, 2)


ROW = ["kind", "key", "whole", "more", "doc", "tid", "low", "high", "place", "deal", "body"]
ROW_SCHEMA = "kind int, key long, whole long, more long, doc long, tid long, low long, high long, place long, deal long, body binary"
#: place holds how far the anchor lies behind the first window, and the least and the greatest distance from window to anchor that the key stands for.
_NEAR, _FAR = 1 << 16, 1 << 32
#: Kinds of rows: contexts that are compared with all of their anchor, spans of bytes to remove, contexts that have only been compared with a part of their class.
OPEN, REMOVED, SALTED = 0, 1, 2


def _spread(*parts: np.ndarray) -> np.ndarray:
    """A hash of several integers."""
    out = np.zeros(len(parts[0]), _U)
    with np.errstate(over="ignore"):
        for p in parts:
            out = _mix(out * _U(_BASE) + p.view(_U) + _U(1))
    return out.view(np.int64)


def _rows(kind, key, whole, more, doc, tid, low, high, place, deal, body=None) -> pa.RecordBatch:
    n = len(doc)
    ints = [pa.array(np.asarray(x, np.int64)) for x in (key, whole, more, doc, tid, low, high, place, deal)]
    kinds = np.full(n, kind, np.int32) if np.isscalar(kind) else kind.astype(np.int32)
    return pa.RecordBatch.from_arrays([pa.array(kinds), *ints, pa.nulls(n, pa.binary()) if body is None else body], ROW)


def _removed(doc, tid, low, high) -> pa.RecordBatch:
    none = np.zeros(len(doc), np.int64)
    return _rows(REMOVED, none, none, none, doc, tid, low, high, none, _spread(doc, low))


def _merged(key, whole, more, doc, tid, low, high, place, common: np.ndarray | None, body: list[bytes] | None = None) -> Iterator[pa.RecordBatch]:
    """Of contexts that are equal as a whole the first stays; the others are removed. common: anchors whose classes are dealt with a salt (None: all)."""
    order = np.lexsort((low, tid, doc, more, whole, key))
    key, whole, more, doc, tid, low, high, place = (x[order] for x in (key, whole, more, doc, tid, low, high, place))
    again = np.zeros(len(key), bool)
    again[1:] = (key[1:] == key[:-1]) & (whole[1:] == whole[:-1]) & (more[1:] == more[:-1])
    if body is not None:
        body = [body[i] for i in order.tolist()]
        again[1:] &= np.fromiter((a == b for a, b in zip(body[1:], body[:-1], strict=True)), bool, len(body) - 1)
    if again.any():
        yield _removed(doc[again], tid[again], low[again], high[again] + LENGTH)
        body = None if body is None else [b for b, a in zip(body, again.tolist(), strict=True) if not a]
        key, whole, more, doc, tid, low, high, place = (x[~again] for x in (key, whole, more, doc, tid, low, high, place))
    salted = np.ones(len(key), bool) if common is None else np.isin(key, common)
    with np.errstate(over="ignore"):
        salt = (_spread(doc, tid).view(_U) % _U(SALTS)).view(np.int64)
    deal = np.where(salted, _spread(key, whole, more, salt), key)
    yield _rows(np.where(salted, SALTED, OPEN), key, whole, more, doc, tid, low, high, place, deal, None if body is None else pa.array(body, pa.binary()))


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """doc, tid, body (bytes) to lists of contexts: key, first, last, anchor, doc, tid and shift of each, and the bytes they lie in; one BLOCK of bytes at a time."""
    held: list[tuple[int, int, int, bytes]] = []
    size = 0

    def flush() -> Iterator[tuple]:
        blob = b"".join(x[3] for x in held)
        data = np.frombuffer(blob, np.uint8)
        lengths = np.array([len(x[3]) for x in held])
        ends = np.cumsum(lengths)
        begin = ends - lengths
        owner = np.repeat(np.arange(len(held)), lengths)[: len(data) - LENGTH + 1]
        valid = np.arange(len(data) - LENGTH + 1) + LENGTH <= ends[owner]
        key, first, last, anchor = contexts(data, valid)
        own = owner[first]
        shift = np.array([x[2] for x in held]) - begin
        yield key, first, last, anchor, np.array([x[0] for x in held])[own], np.array([x[1] for x in held])[own], shift[own], blob
        held.clear()

    for batch in batches:
        for doc, tid, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            body = body.as_py() or b""
            if len(body) < LENGTH:
                continue
            for at in range(0, len(body) - LENGTH + 1, BLOCK):
                part = body[at : at + BLOCK + LENGTH - 1]
                if held and size + len(part) > BLOCK + LENGTH:
                    yield from flush()
                    size = 0
                held.append((doc, tid, at, part))
                size += len(part)
    if held:
        yield from flush()


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc, tid, body (bytes) to anchors and how often they occur."""
    for key, *_ in _found(batches):
        own, n = np.unique(key, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(n.astype(np.int64))], ["key", "n"])


def _anchors(common: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """doc, tid, body (bytes) to contexts."""
        for key, first, last, anchor, doc, tid, shift, blob in _found(batches):
            if len(key):
                whole = _digests(blob[a:b] for a, b in zip(first.tolist(), (last + LENGTH).tolist(), strict=True))
                yield from _merged(key, whole[:, 0], whole[:, 1], doc, tid, first + shift, last + shift, anchor - first + (_SPAN - 1) * _FAR, common)

    return run


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of all tasks: removes repeated contexts, drops contexts that are alone with their anchor (salted ones stay, since the others of their anchor are elsewhere), passes on the others and what is removed."""
    pending: pa.RecordBatch | None = None
    shared = False
    for batch in batches:
        batch = pa.RecordBatch.from_arrays(batch.columns, ROW)  # all columns nullable, as in the rows made here
        kind = batch.column(0).to_numpy()
        if (kind == REMOVED).any():
            yield batch.filter(pa.array(kind == REMOVED))
            batch = batch.filter(pa.array(kind != REMOVED))
        if pending is not None:
            batch = pa.Table.from_batches([pending, batch]).combine_chunks().to_batches()[0] if batch.num_rows else pending
        if not batch.num_rows:
            continue
        kind, key, whole, more = (batch.column(j).to_numpy() for j in range(4))
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (whole[1:] != whole[:-1]) | (more[1:] != more[:-1]) | (kind[1:] != kind[:-1])
        if batch.column(10).null_count == 0:
            for i in np.flatnonzero(~new).tolist():
                new[i] = batch.column(10)[i] != batch.column(10)[i - 1]
        if not new.all():
            yield _removed(*(batch.column(j).to_numpy()[~new] + (LENGTH if j == 7 else 0) for j in (4, 5, 6, 7)))
            batch, kind, key = batch.filter(pa.array(new)), kind[new], key[new]
        same = key[1:] == key[:-1]
        keep = kind == SALTED
        keep[1:] |= same
        keep[:-1] |= same
        keep[0] |= shared
        # the last one waits: what comes next may share its anchor or repeat it
        shared = bool(keep[-1])
        pending = batch.slice(len(key) - 1)
        keep[-1] = False
        if keep.any():
            yield batch.filter(pa.array(keep))
    if pending is not None and shared:
        yield pending


def _compare(rows: DataFrame, label: str) -> DataFrame:
    """Contexts that are left and spans that go, after salted classes have come together in a second step."""
    parts = process_slots(rows.sparkSession)
    order = ["kind", "key", "whole", "more", "doc", "tid", "low"]
    first = written(rows.repartition(parts, "deal").sortWithinPartitions(*order).mapInArrow(_compared, ROW_SCHEMA), label)
    salted = first.where(F.col("kind") == SALTED)
    if salted.isEmpty():
        return first
    second = salted.repartition(parts, "key", "whole", "more").sortWithinPartitions(*order).mapInArrow(_compared, ROW_SCHEMA)
    second = written(second.withColumn("kind", F.when(F.col("kind") == REMOVED, REMOVED).otherwise(OPEN)), f"{label}-salted")
    return first.where(F.col("kind") != SALTED).unionByName(second)


def _halved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts, with their bytes, as two contexts with half the windows each, under the hash of the bytes that these windows share."""
    for batch in batches:
        out: list[tuple] = []
        bodies: list[bytes] = []
        cores: list[bytes] = []
        for doc, tid, low, high, place, body in zip(*(batch.column(j).to_pylist() for j in (4, 5, 6, 7, 8, 10)), strict=True):
            anchor, near, far = low + place % _NEAR, place % _FAR // _NEAR, place // _FAR
            middle = (near + far) // 2
            for n, f in ((middle + 1, far), (near, middle)):
                a, b = max(low, anchor - f), min(high, anchor - n)
                if a <= b and n <= f:
                    cores.append(b"%d %d " % (n, f) + body[anchor - n - low : anchor - f + LENGTH - low])
                    out.append((doc, tid, a, b, anchor - a + n * _NEAR + f * _FAR))
                    bodies.append(body[a - low : b - low + LENGTH])
        if out:
            whole = _digests(bodies)
            yield from _merged(_digests(cores)[:, 0], whole[:, 0], whole[:, 1], *(np.array([o[j] for o in out], np.int64) for j in range(5)), None, bodies)


def repeated_windows(parts: list[bytes], length: int = LENGTH) -> np.ndarray:
    """Starts, in the concatenation of the parts, of all windows inside a part that are equal to an earlier one, by suffix array."""
    # zero ends every part; bytes count from one
    text = np.concatenate([np.append(np.frombuffer(p, np.uint8).astype(np.int64) + 1, 0) for p in parts])
    sizes = np.array([len(p) for p in parts])
    begin = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    end = np.repeat(begin + sizes, sizes + 1)
    order = np.array(suffix_array(text.tolist()), np.int64)
    order = order[order + length <= end[order]]
    if len(order) < 2:
        return np.empty(0, np.int64)
    windows = np.lib.stride_tricks.sliding_window_view(text.astype(np.int16), length)
    equal = np.zeros(len(order), bool)
    for at in range(1, len(order), 4096):
        rows = order[at - 1 : at + 4096]
        equal[at : at + 4096] = (windows[rows[1:]] == windows[rows[:-1]]).all(1)
    heads = np.flatnonzero(~equal)
    first = np.minimum.reduceat(order, heads)
    run = np.cumsum(~equal) - 1
    again = order[order != first[run]]
    owner = np.searchsorted(begin, again, side="right") - 1
    return np.sort(again - owner)


def _partnered(bodies: list[bytes]) -> list[tuple[int, int, int]]:
    """(part, start, end): the stretches of the parts whose windows have an equal one, or one that cannot be told from it by hash, in another place."""
    data = np.frombuffer(b"".join(bodies), np.uint8)
    ends = np.cumsum([len(b) for b in bodies])
    begin = ends - np.array([len(b) for b in bodies])
    at = np.arange(len(data) - LENGTH + 1)
    owner = np.repeat(np.arange(len(bodies)), ends - begin)[: len(at)]
    at = at[at + LENGTH <= ends[owner]]
    h = Hashes(data).of(at, at + LENGTH)
    order = np.argsort(h, kind="stable")
    same = h[order[1:]] == h[order[:-1]]
    twin = np.zeros(len(at), bool)
    twin[order[1:]] |= same
    twin[order[:-1]] |= same
    at = at[twin]
    if not len(at):
        return []
    owner = np.searchsorted(ends, at, side="right")
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (owner[1:] != owner[:-1])
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(at)) - 1
    first = begin[owner[heads]]
    return list(zip(owner[heads].tolist(), (at[heads] - first).tolist(), (at[tails] - first + LENGTH).tolist(), strict=True))


def _settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts with their bytes, sorted by key, to the spans that go; shards hold whole keys."""
    held: list[tuple] = []  # doc, tid, low, bytes
    size = own = 0
    last = None

    def flush() -> pa.RecordBatch:
        held.sort(key=lambda r: r[:3])
        stretches = _partnered([r[3] for r in held])
        # equal stretches are a class again: the first stands for it in the suffix array, the others go
        classes: dict[bytes, int] = {}
        spans: list[list[int]] = []
        for n, (k, a, b) in enumerate(stretches):
            if classes.setdefault(held[k][3][a:b], n) != n:
                spans.append([n, 0, b - a])
        if classes:
            own = list(classes.values())
            again = repeated_windows(list(classes))
            begin = np.concatenate([[0], np.cumsum([len(p) for p in classes])])
            owner = np.searchsorted(begin, again, side="right") - 1
            for i, s in zip(owner.tolist(), (again - begin[owner]).tolist(), strict=True):
                if spans and spans[-1][0] == own[i] and spans[-1][2] >= s:
                    spans[-1][2] = s + LENGTH
                else:
                    spans.append([own[i], s, s + LENGTH])
        rows = []
        for i, a, b in spans:
            k, start, _ = stretches[i]
            doc, tid, low, _ = held[k]
            rows.append((doc, tid, low + start + a, low + start + b))
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], pa.int64()) for j in range(4)], ["doc", "tid", "low", "high"])

    for batch in batches:
        for key, doc, tid, low, body in zip(*(batch.column(j).to_pylist() for j in (1, 4, 5, 6, 10)), strict=True):
            if key != last:
                if own == 1 and len(held[-1][3]) < 2 * LENGTH:  # alone with its anchor, and too short to hold a window twice
                    size -= len(held.pop()[3])
                if size >= SHARD_BYTES:
                    yield flush()
                    size = 0
                last, own = key, 0
            held.append((doc, tid, low, body))
            size += len(body)
            own += 1
    if held:
        yield flush()


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, body, spans to the result; the remaining bytes too."""
    for batch in batches:
        out = []
        for doc, body, spans in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
            body = body.as_py() or b""
            runs: list[list[int]] = []
            for s in sorted((x["low"], x["high"]) for x in spans or ()):
                if runs and runs[-1][1] >= s[0]:
                    runs[-1][1] = max(runs[-1][1], s[1])
                else:
                    runs.append(list(s))
            kept, at = [], 0
            for a, b in runs:
                kept.append(body[at:a])
                at = b
            rest = b"".join(kept) + body[at:]
            out.append((doc, len(body), len(body) - len(rest), len(runs), hashlib.sha256(rest).hexdigest(), rest))
        kinds = [batch.schema.field(0).type, pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        for start in range(0, len(out), 2000):
            part = out[start : start + 2000]
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in part], kinds[j]) for j in range(6)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def removed_spans(docs: DataFrame) -> DataFrame:
    """doc, tid, low, high: spans of bytes that go (they may overlap). docs: doc_id, tid, body (bytes)."""
    whole = docs.where(F.col("doc_id").isNotNull())
    texts = whole.select(F.col("doc_id").alias("doc"), "tid", "body")
    if _repeats(whole):
        texts = texts.dropDuplicates(["doc", "tid"])
    found = _compare(texts.mapInArrow(_anchors(common_anchors(texts)), ROW_SCHEMA), "anchors")
    gone = [found.where(F.col("kind") == REMOVED)]
    asked = found.where(F.col("kind") == OPEN).drop("body")
    part = F.substring("body", (F.col("low") + 1).cast("int"), (F.col("high") - F.col("low") + LENGTH).cast("int"))
    open_ = written(texts.join(asked, ["doc", "tid"]).withColumn("body", part).select(*ROW), "contexts")
    small = []
    wide = F.expr(f"place div {_FAR} - place % {_FAR} div {_NEAR}")
    while True:
        # the anchors whose contexts are too many for one place: no more than all bytes over that bound
        hot = written(open_.groupBy("key").agg(F.sum(F.octet_length("body")).alias("held"), F.max(wide).alias("wide")).where((F.col("held") > SPLIT_BYTES) & (F.col("wide") > 0)).select("key"), "hot")
        if hot.isEmpty():
            small.append(open_)
            break
        small.append(open_.join(hot, "key", "left_anti").select(*ROW))
        halves = _compare(open_.join(hot, "key", "left_semi").select(*ROW).mapInArrow(_halved, ROW_SCHEMA), "halves")
        gone.append(halves.where(F.col("kind") == REMOVED))
        open_ = halves.where(F.col("kind") == OPEN)
    rows = reduce(DataFrame.unionByName, small)
    dealt = rows.repartition(process_slots(docs.sparkSession), "key").sortWithinPartitions("key", "doc", "tid", "low")
    gone.append(written(dealt.mapInArrow(_settled, "doc long, tid long, low long, high long"), "settled"))
    spans = gone[0].select("doc", "tid", "low", "high")
    for more in gone[1:]:
        spans = spans.unionByName(more.select("doc", "tid", "low", "high"))
    return spans


def common_anchors(texts: DataFrame) -> np.ndarray:
    """The anchors that occur COMMON times or more in about SAMPLE_DOCS documents, ascending; so many rows bound their number."""
    share = min(1.0, SAMPLE_DOCS / max(1, texts.count()))
    sample = texts.where(F.pmod(F.xxhash64("doc", "tid"), F.lit(1 << 30)) < int(share * (1 << 30)))
    found = sample.mapInArrow(_sampled, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= COMMON).select("key").collect()
    return np.sort(np.array([r["key"] for r in found], np.int64))


def _repeats(docs: DataFrame) -> bool:
    return not docs.groupBy("doc_id").count().where("count > 1").isEmpty()


def dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row, and kept: the bytes that remain."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    tid = F.xxhash64("text") if _repeats(ids.where(F.col("doc_id").isNotNull())) else F.lit(0).cast("long")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), tid.alias("tid"), F.col("text").cast("binary").alias("body"))
    spans = removed_spans(rows).groupBy("doc", "tid").agg(F.collect_list(F.struct("low", "high")).alias("spans"))
    joined = rows.join(spans, (F.col("doc_id") == F.col("doc")) & (rows["tid"] == spans["tid"]), "left").select("doc_id", "body", "spans")
    return joined.mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
