import os

import pytest

import __spark_entry__ as entry

SMALL = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")
@pytest.mark.parametrize("name", ["map_filter_keep_list", "pair_reasons", "altloc_pick", "template_align", "nearest_join_tie", "voxel_stencil", "journal_replay", "json_contour", "ring_counts", "score_projection", "distribution_against_one", "density_content_faults"])
def test_query_against_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in os.listdir(SMALL):
        con.sql(f"CREATE VIEW {t.removesuffix('.parquet')} AS FROM '{SMALL}/{t}'")
    got, want = entry.queries()[name](spark, SMALL).toPandas(), con.sql(entry.oracle_sql()[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    said = lambda d: sorted(map(repr, d[columns].astype(object).where(d[columns].notna(), None).astype(str).values.tolist()))
    assert said(got) == said(want)
