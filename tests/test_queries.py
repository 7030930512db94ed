"""Every registered query runs on a small table set; those with SQL give the same rows."""

import os

import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the test tables")
def test_queries_equal_their_sql(spark):
    import duckdb

    from corvane.plans import catalog

    con = duckdb.connect()
    for t in os.listdir(DATA):
        con.sql(f"create view {t.removesuffix('.parquet')} as select * from '{DATA}/{t}'")
    form = lambda v: "null" if v is None or v != v else format(float(v), ".8g") if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    for name in ("select_nullsafe", "join_exact_report", "route_integrity", "reservation", "spot_audit", "business_rates", "leakage_group_ids", "review_step", "components_sparse", "release_gate"):
        cols = sorted(con.sql(catalog.ORACLES[name]).columns)
        want = sorted(tuple(map(form, (r[c] for c in cols))) for r in con.sql(catalog.ORACLES[name]).df().astype(object).where(lambda x: x.notna(), None).to_dict("records"))
        got = sorted(tuple(map(form, (r[c] for c in cols))) for r in catalog.QUERIES[name](spark, DATA).collect())
        assert got == want, name


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the test tables")
def test_all_queries_equal_their_sql(spark):
    import duckdb

    from corvane.plans import catalog

    con = duckdb.connect()
    for t in os.listdir(DATA):
        con.sql(f"create view {t.removesuffix('.parquet')} as select * from '{DATA}/{t}'")
    form = lambda v: "null" if v is None or v != v else format(float(v), ".8g") if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    unlike = []
    for name in sorted(catalog.ORACLES):
        found = con.sql(catalog.ORACLES[name])
        cols = sorted(found.columns)
        at = [found.columns.index(c) for c in cols]
        want = sorted(tuple(form(r[i]) for i in at) for r in found.fetchall())
        got = sorted(tuple(map(form, (r[c] for c in cols))) for r in catalog.QUERIES[name](spark, DATA).collect())
        if got != want:
            unlike.append(name)
    assert not unlike
