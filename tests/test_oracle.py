"""Catalog queries next to their SQL; LEDGERGLASS_ALL_QUERIES=1 runs every one."""

import os
from pathlib import Path

import pytest

import __spark_entry__ as entry
from tools.check_oracle import connect, rows_of

SF_DIR = "/root/testdata/sf0.001"
SOME = [
    "merchant_delayed_risk",
    "card_rolling_amount",
    "rates_by_dimension",
    "time_flags",
    "ordinal_encode",
    "fuzzy_match",
    "split_rows",
    "roc_auc",
    "precision_at_fraud_count_day",
    "ks_drift",
    "feature_table",
    "card_gap",
    "carried_windows",
    "known_risk_enrich",
    "train_risk_enrich",
    "table_profile",
    "frequent_values",
    "corr_matrix_with_nulls",
    "hex_density",
    "sketched_quantiles",
    "sketched_cards",
    "geodesic",
    "updated_gazetteer",
    "spread_all_points",
]
NAMES = sorted(entry.oracle_sql()) if os.environ.get("LEDGERGLASS_ALL_QUERIES") else SOME

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="needs the test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, con, name):
    df = entry.queries()[name](spark, SF_DIR)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(columns)
    assert got == rows_of(columns, cur.fetchall())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "trans_num" and df.count() > 0
