from __future__ import annotations

import numpy as np
import pytest
from compare import assert_same, connection

from framelake.plans import catalogue

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connection(SF)


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_query_equals_sql(spark, con, name):
    assert_same(catalogue.QUERIES[name](spark, SF), con, catalogue.SQL[name])


def sanity_tables(spark, folder, values):
    spark.createDataFrame([(float(v),) for v in values], "value double").coalesce(1).write.parquet(f"{folder}/events.parquet")
    spark.createDataFrame([([0.0, 1.0],)], "embedding array<float>").coalesce(1).write.parquet(f"{folder}/embeddings.parquet")
    return str(folder)


def connection_to_rows(sf):
    """Min and max from the rows: a Parquet file states a minimum of 0 as -0.0, whatever the sign of its zeros."""
    con = connection(sf)
    con.execute("set disabled_optimizers = 'statistics_propagation'")
    return con


@pytest.mark.parametrize("values", [(0.0001, 12345678.9), (0.00002, 1e7), (-1e-7, 3e15), (-0.0, 1e16), (-4432483935.774388, 1.2345e22), (2.5e-6, 5.0000005), (-1e300, 3.909497031332271e17), (0.0, 0.004)], ids=str)
def test_sanity_report_writes_numbers_as_sql(spark, tmp_path, values):
    sf = sanity_tables(spark, tmp_path, values)
    assert_same(catalogue.QUERIES["sanity_report"](spark, sf), connection_to_rows(sf), catalogue.SQL["sanity_report"])


@pytest.mark.parametrize("values", [(0.0, -0.0, 1.0), (-0.0, 0.0, 1.0)], ids=str)
def test_sanity_report_picks_a_zero_whatever_the_order(spark, tmp_path, values):
    got = catalogue.QUERIES["sanity_report"](spark, sanity_tables(spark, tmp_path, values))
    assert got.where("name = 'min'").first()["observed"] == "-0.0"


def test_sanity_report_counts_rows_where_sql_may_read_footers(spark):
    sf = "/root/testdata/sf0.1"
    assert_same(catalogue.QUERIES["sanity_report"](spark, sf), connection_to_rows(sf), catalogue.SQL["sanity_report"])


def test_pca_equals_numpy(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    x = np.array([r["embedding"] for r in rows], float)
    c = x - x.mean(0)
    _, _, vt = np.linalg.svd(c, full_matrices=False)
    vt = np.array([v * np.sign(v[np.abs(v).argmax()]) for v in vt[:3]])
    p = c @ vt.T
    lo, hi = np.percentile(p, 2, axis=0), np.percentile(p, 98, axis=0)
    want = np.clip((p - lo) / (hi - lo), 0, 1)
    got = catalogue.pca_rgb(spark, SF).orderBy("vec_id").collect()
    assert np.allclose([[r["red"], r["green"], r["blue"]] for r in got], want, atol=2e-6)


def test_entry_and_columns(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() > 0 and set(e.oracle_sql()) <= set(e.queries())
