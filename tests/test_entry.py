"""Driver contract: entry() on sf0.001, and every registered query has an oracle."""
import importlib

from conftest import SF_SMALL

from ontime_spark import oracle_sql, registry

# Queries without a DuckDB statement: iterative model fits (rows-only check by the driver).
NO_ORACLE = {"m1_lr_train_evaluate", "m3_boosted_train_score", "l8_l9_train_compare_score"}  # iterative fits


def test_entry_runs(spark):
    E = importlib.import_module("__spark_entry__")
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) >= 1 and df.columns == ["carrier", "delay_rate_pct"]


def test_every_query_has_oracle():
    assert set(registry.QUERIES) - set(oracle_sql.SQL) == NO_ORACLE
    E = importlib.import_module("__spark_entry__")
    assert set(registry.QUERIES) <= set(E.queries())


def test_queries_run_on_small_data(spark):
    E = importlib.import_module("__spark_entry__")
    for name in ("l6_build_features", "j6_asof_nearest", "m6_classification_metrics"):
        assert E.queries()[name](spark, SF_SMALL).count() >= 0
