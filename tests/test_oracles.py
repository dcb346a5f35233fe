"""Every registered query of the attendance engine against its DuckDB oracle, on the smallest tables."""

import glob
import math

import duckdb
import pytest

from gatecount.plans.oracles_clean import ORACLE_SQL
from gatecount.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{FOLDER}/*.parquet"):
        con.sql(f"create view {f.rpartition('/')[2][:-8]} as select * from '{f}'")
    return con


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    clean = lambda v: "nan" if isinstance(v, float) and math.isnan(v) else v
    return sorted((tuple(clean(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLE_SQL])
def test_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    rel = duck.sql(ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _rows(df.columns, df.collect()) == _rows(rel.columns, rel.fetchall())


def test_all_have_oracles_but_models_and_name_ratios():
    whole_score = {n.removesuffix("_rules") for n in QUERIES if n.endswith("_rules")}
    assert set(QUERIES) - set(ORACLE_SQL) == {"er_candidates_ratio", "ml_logistic_oof", "ml_boosted_oof", "ml_final_fit", "feature_importance"} | whole_score
