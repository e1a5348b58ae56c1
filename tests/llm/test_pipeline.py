"""The pipeline against a brute-force version of what its stages keep."""

import hashlib
import random
from collections import Counter

import corpus_pipeline
from test_operators import brute_components

EN, FR = "the cat and the dog went to the house with that thing and then slept", "le chat et le chien sont dans la maison avec une chose que nous avons"


def test_pipeline(spark, tmp_path):
    rng = random.Random(8)
    rows = []
    for i in range(60):
        words = (EN if i % 2 else FR).split()
        rows.append((i, " ".join(rng.choice(words) for _ in range(60)), "en" if i % 2 else "fr", "s%d" % (i % 3), 1))
    item = " ".join(f"w{i}" for i in range(14))
    rows += [(100, rows[4][1], "fr", "s0", 1), (101, EN + " " + item, "en", "s1", 1), (102, "12 34", "en", "s1", 1), (103, FR + " password=abcdefghijkl3x", "fr", "s2", 1), (104, None, "en", None, 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = []
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{n}")
        docs = spark.read.parquet(f"{tmp_path}/{n}")
        kept.append({r.doc_id: r.text for r in docs.collect()})
        if n < 4:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    told = {r[0] for r in rows} - {102, 104}
    assert set(kept[0]) == told
    single = {i for i, (_, c, k) in brute_components([(r[0], r[1]) for r in rows if r[0] in told]).items() if k}
    assert set(kept[1]) == single and 100 not in single
    assert set(kept[2]) == single - {101}
    assert set(kept[3]) == set(kept[2]) and kept[3][103] == FR + " [SECRET]"
    # the mix, by the plain rules: every copy whose middle lies below its source's target
    left = {r.doc_id: r for r in spark.read.parquet(f"{tmp_path}/3").collect()}
    sizes = {i: len(r.text.split()) for i, r in left.items()}
    of = {s: sorted((int(hashlib.md5(f"{i}:{r.text}".encode()).hexdigest()[:15], 16), i) for i, r in left.items() if r.source == s) for s in ("s0", "s1", "s2")}
    total, copies = sum(sizes.values()), Counter()
    for n, (s, rows_of) in enumerate(sorted(of.items())):
        target, whole, begin = total * (n + 1) / 6, sum(sizes[i] for _, i in rows_of), 0
        assert target <= 3 * whole
        for _, i in rows_of:
            copies[i] = sum(begin + j * whole + sizes[i] / 2 < target for j in range(3))
            begin += sizes[i]
    mixed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter(r.doc_id for r in mixed) == +copies and [r.position for r in mixed] == sorted(r.position for r in mixed)
    assert set(kept[4]) == set(+copies)


def test_language_stage_rejects_unlearnt_latin_script(spark):
    learnt = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rng = random.Random(1)
    junk = [" ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(2, 9))) for _ in range(n)) for n in (5, 200, 2000)]
    odd = [*junk, "Wczoraj wieczorem poszliśmy do lasu, żeby zebrać grzyby i jagody na zimę", "Eilen illalla menimme metsään keräämään sieniä ja marjoja talveksi"]
    more = spark.createDataFrame([(-1 - i, t, None, "s", len(t)) for i, t in enumerate(odd)], "doc_id long, text string, lang string, source string, n_chars long")
    docs = learnt.select("doc_id", "text", "lang", "source", "n_chars").unionByName(more)
    kept = {r.doc_id for r in corpus_pipeline.identify_language(spark, docs, "").select("doc_id").collect()}
    assert kept == {r.doc_id for r in learnt.select("doc_id", "text").collect() if any(c.isalpha() for c in r.text or "")}
