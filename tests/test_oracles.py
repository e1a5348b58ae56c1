"""Queries against their DuckDB counterparts on the smallest tables."""

import os

import pytest
from oracle import compare

from sievemark.plans import catalog

SF = "/root/testdata/sf0.001"


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", ["clean_users", "clean_movies", "clean_ratings", "quality_summary", "action_counts", "validation_gates", "profile_ratings", "history_transitions", "storage_classification", "duration_distribution", "explore_users", "explore_movies", "explore_ratings", "bad_value_histogram", "event_gates", "backup_coverage", "action_delta", "profile_users", "profile_movies", "id_gaps", "content_gates", "graph_gates", "evidence_read", "run_equivalence", "retention_candidates", "line_source", "orphan_rows"])
def test_oracle(spark, name):
    assert compare(spark, SF, catalog.QUERIES[name], catalog.ORACLES[name]) == ""


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_no_oracle_is_empty():
    import duckdb
    from oracle import TABLES

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.01/{t}.parquet'")
    empty = [name for name, sql in catalog.ORACLES.items() if con.execute(f"SELECT count(*) FROM ({sql.rstrip().rstrip(';')}) AS q").fetchone()[0] == 0]
    assert empty == []
