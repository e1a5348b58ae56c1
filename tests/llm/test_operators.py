"""Every corpus operator on small awkward tables, against brute force or properties that define it."""

import hashlib
import itertools
import random
import re
import time
import uuid
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievemark.llm import common, decontamination, html_text, language_id, mixing, near_dup, secrets, substring_dedup, top_k, toxicity, warc
from sievemark.llm.common import shared_dir
from sievemark.llm.suffix_array import suffix_array

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, size string, h string, gone_id long, bad_id long, bad_h long"


def docs(spark, rows):
    """rows: (doc_id, text[, lang, source]); the last columns clash with names that operators use."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", None, "x", "y", "z", 0, 0, 0) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


AWKWARD = [(1, None), (2, ""), (3, "   \n"), (None, "words without an id"), (4, "one"), (4, "one"), (5, "a b c d e f g h"), (6, "x" * 30000), (7, "é ñ ß 漢字 🙂 " * 20)]


def test_suffix_array():
    rng = random.Random(1)
    for _ in range(3000):
        t = [rng.randrange(rng.choice([1, 2, 4])) for _ in range(rng.randrange(40))]
        t = t + [9] + t[rng.randrange(len(t) + 1) :] if rng.random() < 0.3 else t
        assert suffix_array(t) == sorted(range(len(t)), key=lambda i: t[i:])


def brute_spans(rows, length=100):
    seen, out = set(), {}
    for doc, body in sorted(rows):
        gone = np.zeros(len(body), bool)
        for i in range(len(body) - length + 1):
            w = body[i : i + length]
            if w in seen:
                gone[i : i + length] = True
            seen.add(w)
        kept = bytes(b for b, g in zip(body, gone, strict=True) if not g)
        edges = np.diff(np.concatenate([[0], gone.astype(int), [0]]))
        out[doc] = (len(body), int(gone.sum()), int((edges == 1).sum()), hashlib.sha256(kept).hexdigest())
    return out


def test_substring_dedup(spark, monkeypatch):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randrange(2, 8)))
    passage = " ".join(word() for _ in range(40))
    rows = [(i, " ".join(word() for _ in range(rng.randrange(5, 40))) + (passage[rng.randrange(60) :] if i % 3 else "") + " ".join(word() for _ in range(10))) for i in range(60)]
    rows += [(100, rows[7][1]), (101, rows[7][1] + "!"), (102, "ab" * 300), (103, "z" * 250), (104, "long line of text that repeats itself, word by word, until it is longer than a hundred bytes, surely.\n" * 5), (105, None), (106, "")]
    monkeypatch.setattr(substring_dedup, "SPLIT_BYTES", 2000)
    monkeypatch.setattr(substring_dedup, "COMMON", 6)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in substring_dedup.dedup(docs(spark, rows)).collect()}
    assert got == brute_spans([(i, (t or "").encode()) for i, t in rows])


def test_substring_dedup_repeated_rows(spark):
    text = "the same row twice, which counts as a single document and so loses nothing at all to its own copy, however long it is"
    got = substring_dedup.dedup(docs(spark, [(1, text), (1, text), (None, text), (2, text)])).collect()
    assert sorted((r.doc_id or 0, r.n_removed > 0) for r in got) == [(0, False), (1, False), (1, False), (2, True)]


def brute_components(rows, percent=85):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}

    def find(x):
        return x if root[x] == x else find(root[x])

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def test_near_dup(spark, monkeypatch):
    rng = random.Random(3)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    rows = []
    for i in range(90):
        own = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 4])):
            own[rng.randrange(len(own))] = f"v{rng.randrange(10**6)}"
        rows.append((i, " ".join(own)))
    rows += [(200 + i, " ".join(f"u{rng.randrange(50)}" for _ in range(30))) for i in range(30)]
    rows += [(300, None), (301, ""), (302, "One"), (303, "one"), (304, "a b c"), (305, "A B  C")]
    monkeypatch.setattr(near_dup, "SMALL_BUCKET", 4)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dup.near_duplicates(docs(spark, rows)).collect()}
    assert got == brute_components(rows)


def test_near_dup_unlike_every_head_of_large_buckets(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "SMALL_BUCKET", 4)
    whole = [f"w{i}" for i in range(200)]
    # the whole and forty words of their own: too large to link with the whole, but in its buckets
    rows = [(i, " ".join(whole + [f"x{i}-{j}" for j in range(40)])) for i in range(80)]
    rows += [(500, " ".join(whole)), (501, " ".join([*whole[:-1], "changed"]))]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dup.near_duplicates(docs(spark, rows)).collect()}
    assert got[501][1] == 500 and got == brute_components(rows)


def test_near_dup_large_buckets_and_heads(spark, monkeypatch):
    for name in ("SMALL_BUCKET", "LARGE_BUCKET", "PAIRS"):
        monkeypatch.setattr(near_dup, name, 4)
    monkeypatch.setattr(near_dup, "BROADCAST_ROWS", 10**6)
    rng = random.Random(16)
    base = [f"w{i}" for i in range(150)]
    rows = [(i, " ".join([*base[: i % 3], f"v{i}", *base[i % 3 + 1 :]])) for i in range(60)]
    rows += [(100 + i, " ".join(f"u{rng.randrange(9)}" for _ in range(12))) for i in range(20)]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dup.near_duplicates(docs(spark, rows)).collect()}
    assert got == brute_components(rows)


def test_near_dup_one_component_for_a_doc_id(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(5, a), (9, a + " more"), (9, b), (9, None), (20, b), (30, c), (31, c), (31, a), (40, "alone")]
    got = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in near_dup.near_duplicates(docs(spark, rows)).collect()}
    assert {k[0]: v for k, v in got.items()} == {5: (5, True), 9: (5, False), 20: (5, False), 30: (5, False), 31: (5, False), 40: (40, True)}
    assert len(got) == 9 - 1 and all(v == (5, False) for k, v in got.items() if k[0] == 9)
    df = docs(spark, rows)
    kept = near_dup.one_of_each(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [5, 40]


def test_near_dup_nulls_and_repeats(spark):
    got = near_dup.near_duplicates(docs(spark, [(None, "a b c d e f"), (9, "a b c d e f"), (9, "a b c d e f"), (12, "a b c d e f")])).collect()
    assert sorted((r.doc_id or 0, r.component_id, r.kept) for r in got) == [(0, None, True), (9, 9, True), (9, 9, True), (12, 9, False)]


@pytest.mark.parametrize("plan", ["broadcast", "blocks", "shuffle", "often"])
def test_decontamination(spark, monkeypatch, plan):
    if plan != "broadcast":
        monkeypatch.setattr(decontamination, "BLOCK_BYTES", 400)
        monkeypatch.setattr(decontamination, "MOST_BLOCKS", 99 if plan == "blocks" else 0)
    if plan == "often":
        monkeypatch.setattr(decontamination, "OFTEN", 1)
        monkeypatch.setattr(decontamination, "SLOTS", 4)
    rng = random.Random(4)
    item = [f"w{i}" for i in range(25)]
    bench = spark.createDataFrame([(1, " ".join(item)), (10, "tiny item"), (2, " ".join(item[5:20])), (3, None), (4, "..."), (None, "no id here"), (1, " ".join(item))], "item_id long, text string")
    rows = [(i, " ".join(f"x{rng.randrange(9)}" for _ in range(rng.randrange(30))) + " " + " ".join(item[a : a + n]) + " end") for i, (a, n) in enumerate([(0, 25), (3, 10), (3, 9), (15, 10), (0, 0), (7, 14)])]
    rows += [(20, "A TINY, Item! tiny item"), (21, None), (22, ""), (20, "A TINY, Item! tiny item"), (None, " ".join(item))]
    got = Counter(tuple(r)[:6] for r in decontamination.contamination(docs(spark, rows), bench).collect())
    words = lambda t: [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if w]
    windows = {(tuple(w[i : i + min(10, len(w))]), k) for k, t in ((1, " ".join(item)), (10, "tiny item"), (2, " ".join(item[5:20]))) for w in [words(t)] for i in range(len(w) - min(10, len(w)) + 1)}
    want = Counter()
    for i, t in rows:
        w = words(t)
        hit, items = set(), set()
        for win, k in windows:
            for a in range(len(w) - len(win) + 1):
                if tuple(w[a : a + len(win)]) == win:
                    hit |= set(range(a, a + len(win)))
                    items.add(str(k))
        want[(i, len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit))] += 1
    assert got == want
    clean = decontamination.clean(docs(spark, rows), bench)
    assert clean.columns == docs(spark, rows).columns
    assert clean.count() == sum(n for k, n in want.items() if not k[5])
    empty = decontamination.contamination(docs(spark, rows), bench.where("false"))
    assert empty.count() == len(rows) and empty.where("contaminated").isEmpty()


def test_mixing(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(["w"] * rng.randrange(1, 60)), "en", rng.choice(["a", "a", "a", "b", "c", None])) for i in range(600)]
    rows += [(1000, None), (1001, ""), (None, "no id", "en", "b"), (5, "again and again", "en", "a"), (5, "again and again", "en", "a")]
    out = mixing.mix(docs(spark, rows)).collect()
    assert len(out) == len(rows)
    total = sum(len((r[1] or "").split()) for r in rows)
    by = {}
    for r in out:
        assert r.taken in (0, r.size, 2 * r.size, 3 * r.size)
        by.setdefault((r.target, r.source_size), []).append(r.taken)
    assert abs(sum(t for t, _ in by) - total) < 1e-6 * total
    for (target, size), taken in by.items():
        assert target <= 3 * size + 1e-9 and abs(sum(taken) - target) <= 60
    at = [r.positions[0] for r in out if r.positions]
    assert at == sorted(at) and 0 <= at[0] and at[-1] <= 1
    assert all(len(r.positions) == r.copies and r.positions == sorted(r.positions) for r in out)
    assert mixing.mix(docs(spark, rows)).collect() == out
    assert mixing.mix(docs(spark, [])).count() == 0 and mixing.training_order(mixing.mix(docs(spark, []), keep=True)).count() == 0
    order = mixing.training_order(mixing.mix(docs(spark, rows), keep=True))
    assert order.columns[: len(docs(spark, []).columns)] == docs(spark, []).columns
    copies = order.collect()
    assert len(copies) == sum(r.copies for r in out) and [r.position for r in copies] == sorted(r.position for r in copies)


def test_mixing_follows_the_schedule(spark):
    rng = random.Random(15)
    rows = [(i, " ".join(["w"] * rng.randrange(5, 30)), "en", s) for i, s in enumerate(["a"] * 1500 + ["b"] * 1500 + ["c"] * 1500 + ["d"] * 120)]
    order = mixing.training_order(mixing.mix(docs(spark, rows), keep=True)).collect()
    words = {}
    for r in order:
        part = words.setdefault(min(9, int(r.position * 10)), Counter())
        part[r.source] += len(r.text.split())
    target = {r.source: r.target for r in order}
    slope = dict(zip("abcd", (*mixing.SLOPES, mixing.SLOPES[0]), strict=True))
    for tenth, held in words.items():
        for s in "abcd":
            demand = lambda p, s=s: target[s] * (p + slope[s] * (p * p - p))
            want = demand((tenth + 1) / 10) - demand(tenth / 10)
            assert abs(held[s] - want) <= 0.05 * want + 60
    assert max(Counter(r.doc_id for r in order if r.source == "d").values()) == 3


def test_mixing_against_a_plain_version(spark):
    rng = random.Random(17)
    rows = [(rng.choice([i, 7, None]), " ".join(["w"] * rng.randrange(0, 40)) + f" {i % 50}", "en", rng.choice("aaab")) for i in range(300)]
    got = Counter((r.doc_id, r.size, r.taken, tuple(round(p, 9) for p in r.positions)) for r in mixing.mix(docs(spark, rows)).collect())
    by, want = {}, Counter()
    for i, t, _, s in rows:
        by.setdefault(s, []).append((int(hashlib.md5(f"{'' if i is None else i}:{t}".encode()).hexdigest()[:15], 16), i is not None, i or 0, len(t.split()), i))
    total = sum(len(t.split()) for _, t, _, _ in rows)
    sizes = {s: sum(x[3] for x in v) for s, v in by.items()}
    target = {s: total * (n + 1) / 3 for n, s in enumerate("ab")}
    if target["b"] > 3 * sizes["b"]:
        target = {"b": 3.0 * sizes["b"], "a": total - 3.0 * sizes["b"]}
    for n, s in enumerate("ab"):
        k, begin = mixing.SLOPES[n], 0
        for *_, size, i in sorted(by[s], key=lambda x: x[:4]):
            at = []
            for j in range(3):
                y = (2 * (begin + j * sizes[s]) + size) / (2 * target[s])
                if size and y < 1:
                    at.append(round(y if k == 0 else (((1 - k) ** 2 + 4 * k * y) ** 0.5 - (1 - k)) / (2 * k), 9))
            want[i, size, size * len(at), tuple(at)] += 1
            begin += size
    assert got == want


def test_top_k(spark, monkeypatch):
    rng = np.random.default_rng(6)
    monkeypatch.setattr(top_k, "LEAST_ROWS", 64)
    monkeypatch.setattr(top_k, "LEAF", 8)
    monkeypatch.setattr(top_k, "MAX_COMPONENTS", 240)
    monkeypatch.setattr(top_k, "BOX_NUMBERS", 60)
    monkeypatch.setattr(top_k, "QUERY_BLOCK", 30)
    vectors = rng.normal(size=(400, 6)).astype(np.float32)
    vectors[200:260] = vectors[0]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)] + [(500, None), (550, [float("nan")] * 6), (600, [None] + [1.0] * 5), (650, [float("inf")] + [0.0] * 5), (None, [1.0] * 6), (700, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    q = np.floor(256.0 * vectors.astype(np.float64)).astype(np.int64)
    want = []
    for i in range(0, 400, 50):
        s = q @ q[i]
        best = sorted((-int(s[j]), j) for j in range(400) if j != i)[:5]
        want += [(i, r, j, -s_) for r, (s_, j) in enumerate(best, 1)]
    got = sorted(tuple(r) for r in top_k.top_k(top_k.quantised(df), lambda c: c % 50 == 0).collect())
    assert got == sorted(want)
    # every row asks, so that several blocks of queries meet several shards
    want = [(i, r, j, -s_) for i in range(400) for r, (s_, j) in enumerate(sorted((-int(s), j) for j, s in enumerate(q @ q[i]) if j != i)[:5], 1)]
    got = sorted(tuple(r) for r in top_k.top_k(top_k.quantised(df.where("vec_id < 400")), lambda c: c >= 0).collect())
    assert got == sorted(want)
    assert top_k.top_k(top_k.quantised(df.where("false")), lambda c: c % 50 == 0).count() == 0
    # repeated ids: a row's own id is never a candidate, other repeated rows are, one by one
    again = spark.createDataFrame([(50, [1.0, 0.0]), (50, [2.0, 0.0]), (7, [1.0, 1.0]), (7, [1.0, 1.0]), (8, [0.5, 0.0])], "vec_id long, embedding array<float>")
    got = sorted(tuple(r) for r in top_k.top_k(top_k.quantised(again), lambda c: c % 50 == 0, 3).collect())
    assert got == sorted((50, n, i, s * m * 256 * 256 // 2) for m in (1, 2) for n, (i, s) in enumerate([(7, 2), (7, 2), (8, 1)], 1))


def test_top_k_boxes_prune_clustered_shards(spark, monkeypatch):
    monkeypatch.setattr(top_k, "LEAST_ROWS", 50)
    monkeypatch.setattr(top_k, "MAX_COMPONENTS", 400)
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(16, 8)) * 4
    vectors = (centres[np.arange(800) % 16] + rng.normal(size=(800, 8)) * 0.1).astype(np.float32)
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    sent, away = [], top_k._reached
    monkeypatch.setattr(top_k, "_reached", lambda *a: sent.append(away(*a)) or sent[-1])
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in top_k.top_k(top_k.quantised(df), lambda c: c % 50 == 0).collect()}
    q = np.floor(256.0 * vectors.astype(np.float64)).astype(np.int64)
    for i in range(0, 800, 50):
        s = q @ q[i]
        assert [got[i, n] for n in range(1, 6)] == [(j, int(s[j])) for j in sorted((j for j in range(800) if j != i), key=lambda j: (-s[j], j))[:5]]
    assert sent[0].count() < 16 * 16 / 2  # of sixteen shards or so, a query goes to fewer than half


def test_warc_round_trip(spark):
    big = "<p>" + "same payload " * 20
    rows = [(3, "http://a/ b\n", big), (1, None, big), (2, "u", big), (2, "u", big), (4, "u", "tiny"), (5, "u", "tiny"), (6, "u", None), (7, "u", ""), (None, "u", big), (8, "u", "é" * 60000)]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, digest string")
    out = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    manifest = warc.write_archives(pages, out, shards=3, roll_bytes=600)
    assert manifest.agg(F.sum("records")).first()[0] == len(rows) and manifest.count() > 3
    got = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read_archives(spark, out).collect())
    want = Counter()
    for page, _, html in rows:
        body = (html or "").encode()
        again = html == big and page in (2, 3)
        want[page, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", 1 if again else None] += 1
    assert got == want
    texts = {r.page_id: r.payload for r in warc.read_archives(spark, out, payloads=True).where("record_type = 'response'").collect()}
    assert bytes(texts[8]).decode() == "é" * 60000
    again = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    files = lambda m: sorted((r.file, r.sha256) for r in m.collect())
    assert files(warc.write_archives(pages.repartition(5), again, shards=3, roll_bytes=600)) == files(manifest)
    # a commit that runs again accepts what is there, but nothing else of the same size
    listed, known = spark.createDataFrame(manifest.collect(), manifest.schema), files(manifest)
    fs, root = warc.file_system(out)
    fs.delete_dir(f"{root}/manifest")
    assert files(warc.commit(listed, out)) == known
    fs.delete_dir(f"{root}/manifest")
    first = listed.first()
    with fs.open_output_stream(f"{root}/{first.file}", compression=None) as stream:
        stream.write(b"x" * first.bytes)
    with pytest.raises(Exception, match="other contents"):
        warc.commit(listed, out)
    none = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    warc.write_archives(pages.where("false"), none)
    assert warc.read_archives(spark, none).count() == 0


def test_secrets(spark):
    assert secrets.joined(secrets.scan("é password=abcdefghijkl x")) == "assign:2:23"
    assert [s for s in secrets.scan("token: password: abcdefghijklmnop") if s[2] == "assign"] == []
    assert secrets.scan("API_KEY = 'abcdefghijk'") == []
    assert [s[2] for s in secrets.scan("AKIA" + "A1" * 7)].count("access") == 1
    assert secrets.scan("0123456789abcdef")[0] == (0, 16, "hex")
    assert any(s[2] == "entropy" for s in secrets.scan("key kJ8sP2qLx9Zt4Vb7Nw3RfYc6 end"))
    assert not any(s[2] == "entropy" for s in secrets.scan("Donaudampfschifffahrtsgesellschaft 123e4567-e89b-12d3-a456-426614174000 some_long_snake_case_identifier"))
    text = "xT9" * 30
    direct = [i for i in range(len(text) - 19) if -sum(n / 20 * np.log2(n / 20) for n in Counter(text[i : i + 20]).values()) >= 1.5]
    assert secrets.hot_spans(text, 1.5) == [(direct[0], direct[-1] + 20)]
    got = {r.doc_id: r for r in secrets.find_secrets(docs(spark, AWKWARD)).collect()}
    assert got[1].spans == "" and got[1].base_sha256 == hashlib.sha256(b"").hexdigest()
    red = secrets.redacted(docs(spark, [(1, "a password=abcdefghijkl b"), (2, None), (3, "clean")]))
    assert {r.doc_id: r.text for r in red.collect()} == {1: "a [SECRET] b", 2: None, 3: "clean"}


def test_warc_shards(spark):
    assert [warc.shard_count(n) for n in (0, 1, 8 << 20, 1 << 30, 1 << 40)] == [1, 1, 2, 64, 4096]
    rng = random.Random(18)
    # dense ranges far apart, and one id that is heavier than a shard
    ids = [rng.randrange(100) for _ in range(300)] + [10**12 + rng.randrange(3000) for _ in range(900)] + [-(2**60) + i for i in range(200)] + [77] * 400
    bounds, heavy = warc.shard_bounds(spark.createDataFrame([(i, 488) for i in ids] + [(None, 9)], "page_id long, payload_bytes long"), 36)
    assert bounds == sorted(set(bounds)) and dict(heavy)[77] > 5
    held = Counter(sum(b <= i for b in bounds) for i in ids if i != 77)
    assert max(held.values()) <= 2 * len(ids) / 36 and len(held) > 18
    values = spark.createDataFrame([(i,) for i in [*ids, *bounds]], "v long").select("v", warc._at_or_below(bounds, F.col("v")).alias("n")).collect()
    assert all(r.n == sum(b <= r.v for b in bounds) for r in values)
    pages = spark.createDataFrame([(i, "u", f"{n} " * 200) for n, i in enumerate([77] * 60 + [1, 2, 3])], "page_id long, url string, html string")
    out = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    assert warc.write_archives(pages, out, shards=8).where("file like 'shard-%.%-%'").count() > 3
    assert warc.read_archives(spark, out).count() == 63
    assert type(warc.file_system("s3a://bucket/path?region=us-east-1&endpoint_override=localhost:1")[0]).__name__ == "S3FileSystem"


def naive_base(text):
    """The base spans, character by character."""
    found, low = [], text.lower()
    names = ("password", "passwd", "secret", "token", "api_key", "apikey")
    value = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")
    i = 0
    while i < len(text):
        name = next((n for n in names if low.startswith(n, i)), None)
        if name is None:
            i += 1
            continue
        j = i + len(name)
        j += j < len(text) and text[j] in "\"'"
        while j < len(text) and text[j] == " ":
            j += 1
        if j == len(text) or text[j] not in ":=":
            i += 1
            continue
        j += 1
        while j < len(text) and text[j] == " ":
            j += 1
        j += j < len(text) and text[j] in "\"'"
        k = j
        while k < len(text) and text[k] in value:
            k += 1
        if k == j:  # the value needs a character; a second sign, as in "a==b", may be part of it
            i += 1
            continue
        if k - j >= 12:
            found.append((i, k, "assign"))
        i = k
    for kind, first, chars, least in (("access", "AKIA", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 18), ("hex", "", "0123456789abcdef", 16)):
        i = 0
        while i < len(text):
            k = i + len(first) if text.startswith(first, i) else i
            if text.startswith(first, i) and k < len(text) and text[k] in chars:
                while k < len(text) and text[k] in chars:
                    k += 1
                if k - i >= least:
                    found.append((i, k, kind))
                i = k
            else:
                i += 1
    return sorted(found, key=lambda s: (s[0], secrets.KINDS.index(s[2])))


def naive_entropy(text):
    """The entropy spans, each window counted anew."""
    found, chars = [], set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")
    i = 0
    while i < len(text):
        k = i
        while k < len(text) and text[k] in chars:
            k += 1
        if k - i < 20:
            i = max(i + 1, k)
            continue
        start, word = i, text[i:k]
        i = k
        word += "=" * min(2, len(text[k:]) - len(text[k:].lstrip("=")))
        if any(x.fullmatch(word) for x in secrets.ALLOWED):
            continue
        least = secrets.THRESHOLDS[secrets.character_class(word)]
        hot = [a for a in range(len(word) - 19) if -sum(n / 20 * np.log2(n / 20) for n in Counter(word[a : a + 20]).values()) >= least - 1e-9]
        runs = []
        for a in hot:
            if runs and a <= runs[-1][1]:
                runs[-1][1] = a + 20
            else:
                runs.append([a, a + 20])
        found += [(start + a, start + b, "entropy") for a, b in runs if not secrets.allowed(word, a, b)]
    return found


def test_secrets_equal_a_naive_scanner():
    rng = random.Random(12)
    pieces = ["password", "PASSWD", "secret", "Token", "api_key", "apikey", "AKIA", "=", ":", "'", '"', " ", "  ", "\n", "é", "abc", "ABC123", "0123456789abcdef", "deadbeef", "-", "_", "/", "+", ".", "kJ8sP2qLx9Zt4Vb7", "XyQwErTyUiOpAsDf", "the words", "your", "sk_live_"]
    for n in range(6000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 14)))
        if n % 3 == 0:
            text += "".join(rng.choice("abcdefABCDEF0123456789+/_-=") for _ in range(rng.randrange(60)))
        got = secrets.scan(text)
        assert [s for s in got if s[2] != "entropy"] == naive_base(text), text
        assert [s for s in got if s[2] == "entropy"] == naive_entropy(text), text


def test_secrets_of_letters_and_allow_list():
    kinds = lambda t: [s[2] for s in secrets.scan(t)]
    assert kinds("see kJhsPgqLxUZtRVbNwyRfYcQm there") == ["entropy"]
    assert kinds("sk_live_kJhsPgqLxUZtRVbNwyRf") == ["entropy"]
    assert kinds("the path yourhome/kJ8sP2qLx9Zt4Vb7Nw3RfYc6Qm1") == ["entropy"]
    for clean in ("Donaudampfschifffahrtsgesellschaft", "getElementsByTagNameAndClassName", "some_long_snake_case_identifier_2024", "https/www-site-org/path/to/some-page-name", "INTERNATIONALIZATION_SETTINGS", "YOUR_API_KEY_HERE_PLEASE", "this-is/xEXAMPLEkJ8sP2qLx9Zt4"):
        assert kinds(clean) == []


def test_language_id(spark):
    en, fr = "the cat and the dog went to the house with that thing ", "le chat et le chien sont dans la maison avec une chose que "
    rows = [(i, (en if i % 2 else fr) * (1 + i % 4), "en" if i % 2 else "fr") for i in range(80)] + [(100, None, "en"), (101, "123 !!", "fr"), (102, "", None), (None, en, "en")]
    df = docs(spark, rows)
    got = {r.doc_id: r for r in language_id.identify(df, language_id.fit(df)).collect()}
    assert all(got[i].lang_pred == ("en" if i % 2 else "fr") and 0 < got[i].score <= 1 for i in range(80))
    assert [got[i].lang_pred for i in (100, 101, 102)] == ["und"] * 3 and got[None].lang_pred == "en" and got[None].held_out is False
    assert language_id.keep_identified(df, language_id.fit(df), 0.1).count() == 81
    nothing = language_id.fit(df.where("false"))
    assert {r.lang_pred for r in language_id.identify(df, nothing).collect()} == {"und"}
    long = (en * 9000)[: language_id.CHUNK + 5]
    whole = language_id._letters(long)
    codes, counts = language_id.gram_counts(long)
    assert counts[codes == ord("t")][0] == int((whole == ord("t")).sum())


def test_language_id_equals_a_naive_distance(spark):
    rng = random.Random(19)
    sets = {"x": "abcde", "y": "defgh", "z": "abcdefgh"}
    rows = [(n, " ".join("".join(rng.choice(sets[k]) for _ in range(rng.randrange(1, 7))) for _ in range(rng.randrange(1, 30))), k, "s") for n, k in enumerate("xyz" * 40)]
    rows += [(500, "A1b", None), (501, "é漢 é", None), (502, "abc " * 30_000 + "defgh", "x"), (503, "abcd", "a tie"), (504, "abcd", "b tie")]
    df = docs(spark, rows)

    def ranked(texts):
        n = Counter()
        for t in texts:
            for w in re.sub(r"[\W\d_]+", " ", t.lower()).split():
                p = f" {w} "
                n.update(w)
                n.update(p[i : i + 2] for i in range(len(p) - 1))
                n.update(p[i : i + 3] for i in range(len(p) - 2))
        # of equal counts the smaller code, in which longer n-grams come later
        return [g for g, _ in sorted(n.items(), key=lambda x: (-x[1], len(x[0]), x[0]))]

    rest = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5]
    length = 25
    profiles = {k: ranked([r[1] for r in rest if r[2] == k])[:length] for k in {r[2] for r in rest} - {None}}
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(df, language_id.fit(df, length)).collect()}
    for i, t, *_ in rows:
        own = ranked([t])[:length]
        far = {k: sum(abs(own.index(g) - p.index(g)) if g in p else length for g in own) for k, p in profiles.items()}
        best = min(far, key=lambda k: (far[k], k))
        assert got[i][0] == best and abs(got[i][1] - (1 - far[best] / (length * len(own)))) < 1e-9
    assert language_id.identify(df.where("false"), language_id.fit(df)).count() == 0
    many = docs(spark, [(i, "abc", f"l{i}") for i in range(700)])
    assert len(language_id.fit(many).languages) == sum(zlib.crc32(str(i).encode()) % 5 > 0 for i in range(700))
    filled = {r.doc_id: r.lang for r in language_id.keep_identified(df, language_id.fit(df)).collect()}
    assert filled[500] in {r[2] for r in rows} - {None} and filled[0] == "x"


def test_toxicity(spark):
    rng = random.Random(7)
    plain = lambda: " ".join(rng.choice(["river", "stone", "window", "garden", "letter", "morning", "people", "summer"]) for _ in range(20))
    rows = [(i, plain() + (" idiot " + plain() if i % 4 == 0 else "")) for i in range(400)]
    rows += [(1000, "you 1d10t " + plain()), (1001, plain() + " i d i o t"), (1002, "idiiiiiot"), (1003, plain()), (1004, None), (1005, ""), (None, plain())]
    df = docs(spark, rows)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)] + [(None, 1), (5, None), (6, 7)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.score_toxicity(df, toxicity.fit(df, labels)).collect()}
    assert all(got[i].predicted == int(i % 4 == 0) for i in range(400))
    assert [got[i].predicted for i in (1000, 1001, 1002, 1003, 1004, 1005, None)] == [1, 1, 1, 0, 0, 0, 0]
    letters = sum(c.isalpha() for _, t in rows for c in t or "")
    assert toxicity.language_model(df).total == letters
    assert toxicity.fit(df.where("false"), labels).score("idiot") == 0.0 and toxicity.score_toxicity(df.where("false"), toxicity.fit(df, labels)).count() == 0
    repeated = toxicity.score_toxicity(docs(spark, [(1, "idiot"), (1, "idiot")]), toxicity.fit(df, labels)).collect()
    assert repeated[0] == repeated[1] and repeated[0].predicted == 1
    texts = {r.doc_id: r.restored for r in toxicity.restored(df, toxicity.language_model(df)).where("doc_id >= 1000").collect()}
    assert texts[1000].startswith("you idiot ") and texts[1001].endswith(" idiot") and texts[1002] == "idiot" and texts[1004] == ""
    none = toxicity.fit(df, labels.where("false"))
    assert {r.score for r in toxicity.score_toxicity(df, none).collect()} == {0.0}


def test_toxicity_counts_equal_naive_ones(monkeypatch):
    rng = random.Random(13)
    monkeypatch.setattr(toxicity, "CHUNK", 7)
    texts = ["".join(rng.choice("abcé漢ÀĄ 1.-\n") for _ in range(rng.randrange(40))) for _ in range(60)] + ["", "   ", "a"]
    got = toxicity.Counts()
    for t in texts:
        got.add(t)
    want = [Counter(), Counter(), Counter()]
    for t in texts:
        s = [0, 0]
        for c in toxicity.symbols(t.lower() + " ").tolist():
            if c or s[-1]:
                s.append(c)
        for i in range(2, len(s)):
            want[0][s[i]] += s[i] != 0
            want[1][s[i - 1] << 7 | s[i]] += 1
            want[2][s[i - 2] << 14 | s[i - 1] << 7 | s[i]] += s[i - 1] != 0
    for k in range(3):
        assert {i: int(got.of[k][i]) for i in np.flatnonzero(got.of[k]).tolist()} == {i: n for i, n in want[k].items() if n}


def test_toxicity_decoding_equals_the_best_of_all_readings():
    rng = random.Random(14)
    counts = toxicity.Counts()
    counts.add("idiot loser stupid clown people window garden letter simple little " * 3)
    model = toxicity.CharModel(*counts.entries())

    def cost(readings):
        total, a, b = 0.0, " ", " "
        for reading, channel in readings:
            total += channel
            if reading:
                total += model.cost(a, b, reading) if reading.isalpha() or reading == " " else 0.0
                a, b = (b, reading) if reading.isalpha() else (" ", " ")
        return total + (model.cost(a, b, " ") if b != " " else 0.0)

    for _ in range(300):
        observed = "".join(rng.choice("idotle1305$@!. -") for _ in range(rng.randrange(1, 8)))
        ways = list(itertools.product(*toxicity.lattice(observed)))
        said = toxicity.decode(observed, model)
        least = min(map(cost, ways))
        assert any("".join(r for r, _ in w) == said and cost(w) < least + 1e-9 for w in ways)


def test_toxicity_held_out(spark):
    import pyarrow.parquet as pq

    sf = "/root/testdata/sf0.01"
    df, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    truth = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"{sf}/labels.parquet").to_pylist()}
    out = [r for r in toxicity.score_toxicity(df, toxicity.fit(df, labels)).collect() if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in out) >= 0.96 * len(out) and len(out) > 50


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""),
        ("", ""),
        ("<html><body><nav><a href=x>menu</a></nav></body></html>", ""),
        ("<body><nav><li><a href=x>m</a></li></nav><div class='ad'>Buy.</div><article><h1>T &amp; U</h1><p><b>T\n U.<br><p>Body,  with &eacute; text.</p></article><footer>&copy;</footer>", "T & U T U. Body, with é text."),
        ("<article><p>One, two.</p><script>var t='</p>';</script><aside>side</aside><form>f</form><div class='comments'><p>a comment, long, with, commas</p></div><p>Three</article>", "One, two. Three"),
        ("<div id=main><h2>Head</h2><p>" + "word, " * 40 + "</p><p>More text, here.</p></div><div class=sidebar><p>" + "link, " * 90 + "</p></div>", "Head " + ("word, " * 40).strip() + " More text, here."),
        ("<p>cut short, here <b>and the", "cut short, here and the"),
    ],
)
def test_html(html, text):
    assert html_text.extract(html) == text


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<p>if a <![0] b</p><p>c</p>", "if a c"),
        ("<p>a</p><![foo[x]]><p>b</p>", "a b"),
        ("<p>a<![if !IE]>b<![endif]>c</p><p>d</p>", "abc d"),
        ("<p>a&#" + "9" * 5000 + ";b</p><p>c&#" + "0" * 5000 + "65;</p>", "a\ufffdb cA"),
        ("<p>one here</p><![foo[x]]><p>two</p>", "one here two"),
        ("one <!-- unclosed <p>two", "one two"),
        ("<p>a<!-->b<!---->c<!-- > -->d<?php x ?>e</p>", "abcde"),
        ("<p>x <a href='q>r</a> z</p><p>w</p>", "x r z w"),
        ("<p>1 < 2 and </3> so &lt;</p><p>end <a href=", "1 < 2 and so < end"),
        ("<title>open title<p>text", "open title text"),
    ],
)
def test_html_goes_on_after_malformed_markup(html, text):
    assert html_text.extract(html) == text


@pytest.mark.parametrize("attrs", ["class='content no-sidebar'", "id=content class=has-sidebar", "class='post-content share-enabled'", "class=page-with-comments", "class='content widget'"])
def test_html_keeps_containers_whose_names_only_mention_noise(attrs):
    body = "words, " * 40
    page = f"<div {attrs}><p>{body}</p></div><div class='site-footer'><p>foot</p></div><div class='sidebar'><p>side</p></div>"
    assert html_text.extract(page) == body.strip()


def naive_points(root):
    """Points, characters and link characters of every node that scoring keeps, each paragraph walking up by itself."""
    found = {}

    def text(node, inline_only):
        for c in node.children:
            if isinstance(c, str):
                yield c
            elif id(c) in alive and not (inline_only and c.tag in html_text.BLOCK):
                yield from text(c, inline_only)

    def linked(node, inside):
        inside |= node.tag == "a"
        return sum((html_text_len(c) if inside else 0) if isinstance(c, str) else linked(c, inside) for c in node.children if isinstance(c, str) or id(c) in alive)

    def html_text_len(t):
        return len(" ".join(t.split()))

    alive, nodes = set(), []

    def walk(node, in_article, in_link):
        if node.parent is not None and html_text._no_text(node, in_article):
            return
        alive.add(id(node))
        nodes.append((node, in_link))
        for c in node.children:
            if not isinstance(c, str):
                walk(c, in_article or node.tag in ("article", "main"), in_link or node.tag == "a")

    walk(root, False, False)
    for node, in_link in nodes:
        chars = sum(map(html_text_len, text(node, False)))
        found[id(node)] = [0.0, chars, linked(node, in_link)]
    for node, _ in nodes:
        own = list(text(node, True))
        size = sum(map(html_text_len, own))
        if node.tag in html_text.PARAGRAPH and size:
            _, chars, links = found[id(node)]
            points = (1 + sum(t.count(",") for t in own) + size // 100) * (1 - links / chars)
            up = node if node.tag in ("article", "main") else node.parent
            while up is not None:
                found[id(up)][0] += points
                points, up = points / 2, up.parent
    return found, nodes


def test_html_scores_equal_a_naive_walk():
    rng = random.Random(11)
    tags = "div p span a b ul li article section h2 table tr td nav blockquote main br".split()
    for _ in range(150):
        page = "".join(rng.choice([f"<{t}>", f"<{t}>", f"</{t}>", "words, and more ", "x " * rng.randrange(120), f"<{t} class='{rng.choice(['nav', 'content', 'sidebar left', 'x'])}'>"]) for t in (rng.choice(tags) for _ in range(rng.randrange(60))))
        want, nodes = naive_points(html_text.Builder().read(page))
        tree = html_text.Builder().read(page)
        html_text._measure(tree)
        again = [n for n, _ in naive_points(tree)[1]]
        for (a, _), b in zip(nodes, again, strict=True):
            bonus = {"article": 25, "main": 15}.get(b.tag, 0) + (10 if html_text._names(b) & html_text.GOOD_NAME and b.tag != "body" else 0)
            points, chars, links = want[id(a)]
            assert (b.chars, b.linked) == (chars, links) and abs(b.points - (points + bonus if b.scored else 0.0)) < 1e-9


def test_html_takes_long_and_broken_pages_in_linear_time():
    pages = ["<div>ab " * 120_000, "<b>" * 90_000 + "<hr>" * 90_000, "<!-- x>y" * 120_000, "<a " * 300_000, '<a b="c' * 140_000, "<title>" * 140_000, "<p><button>" + "<b>" * 90_000 + "<hr>" * 90_000]
    for page in pages:
        began = time.process_time()
        html_text.extract(page)
        assert time.process_time() - began < 8


def test_html_keeps_headings_and_paragraphs_of_an_article():
    page = "<article><p>One, two.</p><h2 id=related-work>Related</h2><p id=search>Three.</p><section id=social-history><p>Four.</p></section><div class=share-buttons>Share</div></article>"
    assert html_text.extract(page) == "One, two. Related Three. Four."


def test_scratch_tables_can_be_removed(spark, monkeypatch):
    monkeypatch.setattr(common, "_SCRATCH", [])
    assert common.written(spark.range(5), "numbers").count() == 5
    folder = common._SCRATCH[0]
    fs, path = warc.file_system(folder)
    common.remove_scratch()
    assert not common._SCRATCH and fs.get_file_info(path).type.name == "NotFound"


def test_operators_take_awkward_rows(spark):
    df = docs(spark, AWKWARD)
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    for run in (lambda d: substring_dedup.dedup(d), lambda d: near_dup.near_duplicates(d), lambda d: decontamination.contamination(d, bench), lambda d: mixing.mix(d), lambda d: secrets.find_secrets(d)):
        assert run(df).count() == len(AWKWARD)
        assert run(df.where("false")).count() == 0
    pages = spark.createDataFrame([(None, None, None), (1, "u", "<p>x")], "page_id long, url string, html string")
    assert html_text.main_text(pages).count() == 2 and html_text.main_text(pages.where("false")).count() == 0
    ties = docs(spark, [(i, "a b c", "en", "s") for i in range(9)])
    assert sorted(r.taken for r in mixing.mix(ties).collect()) == sorted(r.taken for r in mixing.mix(ties.repartition(3)).collect())
