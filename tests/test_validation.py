"""Graphs, claims, storage, timing, paging, files and backups on small cases."""

import pytest
from pyspark.sql import functions as F

from sievemark.operators import backup, comparing, conclusions, evidence, exploring, history, paging, quality, storage, timing, validation
from sievemark.sources.files import digest, put_once


def graph(spark, states, edges, related):
    src = spark.createDataFrame([(i, t, s) for i, (t, s) in states.items()], "source_id string, source_table string, disposition string")
    e = spark.createDataFrame(edges, "source_id string, target string")
    r = spark.createDataFrame(related, "source_id string, related_id string")
    return {x["gate"]: x["violations"] for x in validation.graph_gates(src, e, r).collect() if x["violations"]}


CHAIN = {"a": ("movies", "DEDUP"), "b": ("movies", "DEDUP"), "c": ("movies", "DEDUP"), "d": ("movies", "DEDUP"), "e": ("movies", "DEDUP"), "w": ("movies", "KEEP"), "x": ("users", "KEEP"), "i": ("movies", "ISOLATE")}
LONG = [("a", "b"), ("b", "c"), ("c", "d"), ("d", "e"), ("e", "w")]
WHOLE = [("w", s) for s in "abcde"]


@pytest.mark.parametrize(
    ("edges", "related", "want"),
    [
        (LONG, WHOLE, {}),
        (LONG[:-1] + [("e", "a")], WHOLE, {"loop": 5, "lineage_foreign": 5}),
        (LONG[:-1] + [("e", "i")], WHOLE, {"not_kept": 5, "lineage_omitted": 5, "lineage_foreign": 5}),
        (LONG[:-1] + [("e", "x")], WHOLE, {"edge_foreign": 1, "lineage_omitted": 5, "lineage_foreign": 5}),
        (LONG[:-1], WHOLE, {"edge_missing": 1, "not_kept": 4, "lineage_omitted": 4, "lineage_foreign": 5}),
        (LONG, WHOLE[1:], {"lineage_omitted": 1}),
        (LONG + [("e", "w")], WHOLE, {"edge_repeated": 1}),
    ],
)
def test_graph(spark, edges, related, want):
    assert graph(spark, CHAIN, edges, related) == want


def test_long_chain_is_resolved(spark):
    n = 300
    e = spark.createDataFrame([(f"n{i}", f"n{i + 1}") for i in range(n)], "source_id string, target string")
    out = validation.resolved(e).collect()
    assert len(out) == n and {r.winner for r in out} == {f"n{n}"} and not any(r.looped for r in out)


def test_report_pointers():
    report = {"scores": {"users": {"clean": {"unique": 99.5, "ok": True, "odd": float("nan")}}}, "limitations": ["first"], "secret": {"x": 1}}
    assert conclusions.lookup(report, "/scores/users/clean/unique") == 99.5 and conclusions.lookup(report, "/limitations/0") == "first"
    for pointer, said in [("scores", "INVALID_REPORT_POINTER"), ("/secret/x", "NOT_ALLOWED"), ("/scores/movies", "NOT_FOUND"), ("/limitations/1", "NOT_FOUND"), ("/scores/users", "NOT_SCALAR"), ("/scores/users/clean/ok", "NOT_SCALAR"), ("/scores/users/clean/odd", "NOT_FINITE"), ("/scores/a~0b", "INVALID")]:
        with pytest.raises(ValueError, match=said):
            conclusions.lookup(report, pointer)
    assert conclusions.flattened({"a": [1, {"b": None}]}) == [("/a/0", 1), ("/a/1/b", None)]
    with pytest.raises(ValueError, match="TOO_LARGE"):
        conclusions.checked_size(51, 0, 0)


def test_conclusions(spark):
    facts = spark.createDataFrame([("/split/train", 6.0), ("/scores/users/delta/up_to_date", None)], "pointer string, value double")
    claims = spark.createDataFrame([(1, "/split/train", 6.0), (1, "/scores/users/delta/up_to_date", None), (2, "/split/train", 6.0), (2, "/split/train", 6.0), (2, "/split/train", 7.0), (3, "/split/valid", 1.0)], "claim_set int, pointer string, said double")
    rows = spark.createDataFrame([("e1", "R7", "dedup", None)], "evidence_id string, rule_id string, action string, metric string")
    told = spark.createDataFrame([(1, "e1", "R7", "dedup", None), (2, "e1", "R7", "keep", None), (3, "e2", "R7", "dedup", None)], "claim_set int, evidence_id string, rule_id string, action string, metric string")
    out = conclusions.conclusions(conclusions.report_claims(facts, claims), conclusions.evidence_claims(rows, told, ["rule_id", "action", "metric"]))
    assert {r.claim_set: (r.accepted, r.rejected, r.status) for r in out.collect()} == {1: (3, 0, "VERIFIED"), 2: (1, 2, "PARTIAL"), 3: (0, 2, "REJECTED")}


def test_gates_do_not_hold_the_rules_in_their_plan(spark):
    from sievemark.plans import catalog

    plan = catalog.QUERIES["validation_gates"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert len(plan) < 100_000


def _evidence_plan(spark, name):
    from sievemark.plans import catalog

    return catalog.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()


def test_evidence_moves_without_its_ids(spark):
    # ids are made again behind the shuffle, from tables that do not hold them
    for name in ("evidence_index", "evidence_index_gates"):
        plan = _evidence_plan(spark, name)
        assert not [x for x in plan.split("\n") if "FileScan" in x and "evidence_id" in x], name
        assert "SortMergeJoin" not in plan
    assert _evidence_plan(spark, "evidence_index").count("Exchange hashpartitioning") == 1


def test_a_page_of_evidence_moves_no_other_bodies(spark):
    assert "LeftSemi" in _evidence_plan(spark, "evidence_read")


def test_a_page_is_read_from_its_parts_of_the_index(spark):
    from sievemark.operators import cleaning
    from sievemark.sources import synthetic

    cleaned = cleaning.settled(synthetic.raw(spark, "/root/testdata/sf0.001"))
    rows = evidence.held(cleaned, evidence.seen(cleaned))
    for after, limit in (("4", 50), ("3fff", 3), ("fff", 100), ("g", 5)):
        near = rows.where(evidence.page_parts(rows, after, limit, source_table="movies"))
        pages = [sorted(map(str, evidence.read_page(evidence.index(d), rows, after, limit, source_table="movies").collect())) for d in (near, rows)]
        assert pages[0] == pages[1]
        assert near.count() < rows.count() / 4


def test_gates_on_the_index_leave_parts_where_they_are(spark):
    ids = ["00a", "00b", "01a", "01b", "01c"]
    values = [("t", "f", i, "s", x, 0, "QUALITY", "before", "m", "r", "a", None, None, None, 1, 1, "KEEP", x[:2]) for i, x in enumerate(ids)]
    rows = spark.createDataFrame(values, "source_table string, source_file string, source_offset long, source_id string, evidence_id string, event_order int, kind string, phase string, metric string, rule_id string, action string, before string, after string, target string, numerator long, denominator long, final_disposition string, part string")
    assert evidence.parted(rows) is rows
    # two parts share the places 0 and 1, one part has 65 twice
    places = dict(zip(ids, (0, 1, 0, 1, 65), strict=True))
    at = F.create_map(*(F.lit(x) for kv in places.items() for x in kv))[F.col("evidence_id")]
    known = rows.select("evidence_id", "part", F.lit("file").alias("file_path"), at.cast("long").alias("position"), evidence.body_hash().alias("body_sha256"))
    known = known.unionByName(known.where("evidence_id = '01c'").withColumn("evidence_id", F.lit("01d")))
    got = {r.gate: r.violations for r in evidence.index_gates(known, rows.where("evidence_id <> '00b'")).collect()}
    assert got == {"not_indexed": 0, "no_body": 2, "changed": 0, "place_used_twice": 3}


def test_content_gates_in_slices(spark, monkeypatch):
    from oracle import compare
    from sievemark.plans import catalog

    monkeypatch.setattr(validation, "SLICE_ROWS", 600)
    assert compare(spark, "/root/testdata/sf0.001", catalog.QUERIES["content_gates"], catalog.ORACLES["content_gates"]) == ""


def test_gates_at_once_count_as_row_by_row(spark):
    event = lambda rule, action, target=None: [(rule, action, "a", "b", target)]
    row = lambda t, i, line, state, e: (t, f"{t}.dat", i, f"{t}-{i}", line, line, e, state)
    kind = "source_table string, source_file string, source_offset long, source_id string, raw_record string, payload string, events array<struct<rule:string,action:string,before:string,after:string,target:string>>, disposition string"
    users = [row("users", i, f"{i}::F::25::3::12345", "KEEP", event("U0", "keep")) for i in range(1, 9)] + [row("users", 9, "x", "ISOLATE", event("U1b", "isolate")), row("users", 10, "y", "ISOLATE", event("U1b", "isolate"))]
    movies = [row("movies", i, f"{i}::T{i} (1999)::Drama", "KEEP", event("M0", "keep")) for i in range(1, 4)]
    ratings = [row("ratings", i, f"{i}::1::4::978300760", "KEEP", event("R0", "keep") * 2) for i in range(1, 6)]
    cleaned = {t: spark.createDataFrame(d, kind) for t, d in (("users", users), ("movies", movies), ("ratings", ratings))}
    seen = evidence.seen(cleaned)
    run = {k: d.localCheckpoint() for k, d in validation.held(cleaned, seen).items()}
    at = lambda name, *ids: run[name].where(F.col("source_id").isin(*ids))
    told = lambda d, when, **v: validation.changed(d, F.expr(when), **v)
    ev, q = run["evidence"], run["quality"]
    other = run | {
        # rows that are missing, changed, twice, of no source, without id, of an unknown phase, kind, metric or order
        "evidence": told(told(told(told(told(ev.where("not (source_id = 'users-1' and metric = 'unique')"), "source_id = 'users-2' and metric = 'unique'", phase=F.lit("later")), "source_id = 'users-3'", kind=F.lit(None)), "source_id = 'movies-1' and kind = 'TRANSFORMATION'", event_order=F.lit(40)), "source_id = 'movies-2'", source_id=F.lit(None)), "source_id = 'users-9' and kind = 'TRANSFORMATION'", rule_id=F.lit(None))
        .unionByName(at("evidence", "users-4", "ratings-1")).unionByName(told(at("evidence", "users-5"), "true", source_id=F.lit("unknown"), evidence_id=F.lit("forged"))),
        "quality": told(told(q, "source_id = 'users-6'", present=F.lit(None).cast("int")), "source_id = 'users-7'", phase=F.lit("other")).unionByName(at("quality", "ratings-2")).where("source_id <> 'movies-3'"),
        "cleaned_ratings": run["cleaned_ratings"].unionByName(told(at("cleaned_ratings", "ratings-3"), "true", rating=F.lit(9).cast("tinyint"))),
        "quarantine": told(run["quarantine"], "source_id = 'users-10'", reason_rule=F.lit("X9")).unionByName(at("quarantine", "users-10")),
        "cleaned_users": at("cleaned_users", *(f"users-{i}" for i in range(1, 8))),
    }
    want, got = ({r.gate: r.violations for r in validation.summed(parts).collect()} for parts in ([validation.source_gates(other, seen)], validation.source_gates_at_once(other, seen)))
    assert got == want and all(want.values())


def test_number_whitelist_on_units_halves_and_rare_digits(spark, tmp_path):
    from pathlib import Path

    import duckdb
    from oracle import TABLES, compare
    from sievemark.plans import catalog

    # balances end in half a hundredth: 9.905 and -9.995 are rounded by their product with 100
    texts = "40509条, 88分 and 12% or 9.93. \U0001d7d7697% \U0001d7d773.5 8.9% 9.89 9.9 9.909 9.919 3.115 3.105 1.0050 0.145 0.135 2.35 2.36 2.33%"
    balances = ", ".join(f"({b}::DOUBLE)" for b in (990.5, -999.5, 310.5, 100.5, 14.5, 234.5, 1000.5, 500.5))
    con = duckdb.connect()
    con.execute(f"COPY (SELECT 1 AS doc_id, '{texts}' AS text UNION ALL SELECT 2, string_agg(printf('%.2f', i / 100.0), ' ') FROM range(0, 1100) t(i)) TO '{tmp_path}/documents.parquet'")
    con.execute(f"COPY (SELECT * FROM (VALUES {balances}) v(s_acctbal)) TO '{tmp_path}/supplier.parquet'")
    for t in TABLES:
        if not (own := Path(tmp_path, f"{t}.parquet")).exists():
            own.symlink_to(f"/root/testdata/sf0.001/{t}.parquet")
    assert compare(spark, str(tmp_path), catalog.QUERIES["number_whitelist"], catalog.ORACLES["number_whitelist"]) == ""


def test_numbers_in_prose(spark):
    said = spark.createDataFrame([("scores 93.33 and 40509条, task-12.34, v1.25x, 7.5% or 88分, 1.234.5 and 12",)], "t string").select(F.explode(conclusions.numbers(F.col("t"))).alias("number"))
    assert sorted(r.number for r in said.collect()) == ["234.5", "40509", "7.5", "88", "93.33"]
    facts = spark.createDataFrame([(93.34,), (88.0,), (None,), (7.489,)], "fact double")
    assert sorted(r.number for r in conclusions.unsupported(said, facts).collect()) == ["234.5", "40509"]


def test_distribution_and_envelopes(spark):
    values = spark.createDataFrame([("m", v) for v in (10, 20, 30, 40, 90)] + [("r", 7), ("r", 8)], "kind string, millis long")
    got = {r.kind: tuple(r)[1:] for r in timing.distribution(values, ["kind"]).collect()}
    assert got == {"m": (5, 10, 30.0, 90, 90), "r": (2, 7, 7.5, 8, 8)}
    payload = {"complete": True, "jobs": [{"stage": s, "duration_ms": 5} for s in timing.STAGES]}
    text = timing.envelope("b1", payload)
    assert timing.opened(text, "b1") == payload
    for broken, name in ((text, "b2"), (text.replace(":5", ":6", 1), "b1"), (timing.envelope("b1", payload | {"jobs": payload["jobs"][1:]}), "b1")):
        with pytest.raises(ValueError):
            timing.opened(broken, name)


def test_pages(spark):
    rows = spark.range(1, 11).withColumnRenamed("id", "k")
    page = paging.page(rows, "k", None, 4, descending=True).collect()
    assert [r.k for r in page] == [10, 9, 8, 7] and {r.next_cursor for r in page} == {7}
    last = paging.page(rows, "k", 3, 4, descending=True).collect()
    assert [r.k for r in last] == [2, 1] and {r.next_cursor for r in last} == {None}
    for limit in (0, 101):
        with pytest.raises(ValueError):
            paging.page(rows, "k", None, limit)
    for runs in (["a"], ["a", "a"], [str(i) for i in range(11)]):
        with pytest.raises(ValueError):
            paging.series(runs)


def test_storage_refuses_odd_paths(spark):
    for paths, said in ((["/ml/a", "/other/b"], "outside"), (["/ml/../b"], "outside"), (["/ml/a", "/ml/a"], "twice")):
        with pytest.raises(ValueError, match=said):
            storage.checked(spark.createDataFrame([(p,) for p in paths], "path string"))
    with pytest.raises(ValueError):
        storage.retention(None, None, None, 0)


def test_the_newest_generation_of_a_publication_protects(spark):
    files = spark.createDataFrame([(f"/ml/published/p/{t}/f", 1, 50) for t in ("t1", "t2")] + [("/ml/published/p/t2/inner/g", 1, 50)], "path string, bytes long, modified_days int")
    pubs = spark.createDataFrame([("p", 1, "/ml/published/p/t1", "PUBLISHED", "r", "a"), ("p", 2, "/ml/published/p/t2", "UPLOADING", "r", "a"), ("q", 1, "/ml/published/p/t2/inner", "PUBLISHED", "s", "a")], "publish_id string, token int, storage_path string, status string, run_id string, attempt_id string")
    raw = spark.createDataFrame([], "storage_uri string")
    attempts = spark.createDataFrame([], "run_id string, attempt_id string, status string, lease_alive boolean")
    got = {r.path: (r.classification, r.publish_id) for r in storage.classify(files, pubs, raw, attempts).collect()}
    assert got == {"/ml/published/p/t1/f": ("RETAINED_PUBLICATION_HISTORY", "p"), "/ml/published/p/t2/f": ("PENDING_PUBLICATION", "p"), "/ml/published/p/t2/inner/g": ("PROTECTED_PUBLISHED", "q")}


def test_multisets_see_order_nulls_and_multiplicity(spark):
    t = lambda *rows: {"x": spark.createDataFrame(rows, "id int, l array<string>, run_id string")}
    left = t((1, ["a", "b"], "r1"), (1, ["a", "b"], "r1"), (2, None, "r1"))
    same = comparing.multisets(left, t((2, None, "r2"), (1, ["a", "b"], "r2"), (1, ["a", "b"], "r2"))).first()
    assert same.equal and (same.left_rows, same.right_rows) == (3, 3)
    other = comparing.multisets(left, t((1, ["b", "a"], "r"), (1, ["a", "b"], "r"), (2, [], "r"))).first()
    assert not other.equal and (other.left_only, other.right_only) == (2, 2)


def test_files_are_never_replaced(tmp_path):
    uri = f"file://{tmp_path}/x/y.json"
    sha = put_once(b"one", uri)
    assert put_once(b"one", uri) == sha and digest(uri) == (3, sha)
    with pytest.raises(ValueError, match="other contents"):
        put_once(b"two", uri)


def test_backup_round_trip(spark, tmp_path):
    df = spark.sql("SELECT 1L AS a, 'é\"\n' AS b, CAST(NULL AS double) AS c, date'2020-02-03' AS d, timestamp'2020-02-03 04:05:06.789' AS e, X'00ff' AS f, CAST(1.50 AS decimal(9,2)) AS g, true AS h")
    backup.write(df, f"{tmp_path}/b")
    back = backup.restored(spark, f"{tmp_path}/b", df.schema)
    assert back.collect() == df.collect() and back.dtypes == df.dtypes
    other = spark.sql("SELECT 'text' AS a").schema
    with pytest.raises(Exception, match="another kind"):
        backup.restored(spark, f"{tmp_path}/b", other).collect()


def test_history_tables_are_checked(spark, tmp_path):
    t = spark.createDataFrame([("users", 5)], "source_table string, n int")
    folder = f"{tmp_path}/versions"
    assert history.project({"users": t}, folder, "v1") == {"users": 1}
    with pytest.raises(Exception, match="already exists|ALREADY_EXISTS"):
        history.project({"users": t}, folder, "v1")
    named = history.register(spark, folder, {"users": t}, "checked_history")
    assert history.odd_table(spark, named["users"], t, f"{folder}/users") == []
    assert history.odd_table(spark, named["users"], t.withColumn("more", F.lit(1)), f"{tmp_path}/else") == ["columns", "location"]
    assert history.analysis(spark, named, "v1", {"users": 2}, {"users": F.col("source_table") == "users"}).first()["reconciled"] is False
    spark.sql("DROP TABLE checked_history_users")
    for bad in ("a b", "../x", "x'y"):
        with pytest.raises(ValueError):
            history.literal(bad)


def test_file_profiles(spark, tmp_path):
    (tmp_path / "a").write_bytes("é\r\nb\n\n".encode())
    (tmp_path / "b").write_bytes(b"\xe9\n")
    got = {r.path[-1]: (r.bytes, r.whole_utf8, r.crlf, r.lines) for r in exploring.files(spark.read.format("binaryFile").load(str(tmp_path))).collect()}
    assert got == {"a": (7, True, 1, 2), "b": (2, False, 0, 1)}


def test_evidence_pages_have_bounds(spark):
    with pytest.raises(ValueError):
        evidence.read_page(None, None, "", 101)


def test_counters_are_scanned_with_their_keys(spark):
    good = spark.createDataFrame([("after", "users", "N", 5), ("after", "users", "ACC", 4)], "phase string, source_table string, key string, value long")
    row = quality.scan_counters(good).first()
    assert (row["n"], row["acc"], row["ud"]) == (5, 4, 0)
    for key, value in (("OTHER", 1), ("N", -1)):
        with pytest.raises(ValueError):
            quality.scan_counters(good.unionByName(spark.createDataFrame([("after", "movies", key, value)], good.schema)))
    with pytest.raises(ValueError):
        quality.scan_counters(good.unionByName(good))
