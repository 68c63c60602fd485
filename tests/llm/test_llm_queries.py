"""Registered queries: names, guard, and DuckDB statements where there are some."""
import importlib
import os
import re
import sys
from collections import Counter

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))
from check_oracle import TABLES, duck_rows, spark_rows  # noqa: E402

E = importlib.import_module("__spark_entry__")
from ontime_spark.llm import registry  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    numbers = Counter(int(m[1]) for n in E.queries() if (m := re.match(r"op(\d+)_", n)))
    assert numbers == Counter(range(1, 14)) and "pipeline" in E.queries()


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_matches_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    s_cols, s_rows = spark_rows(E.queries()[name](spark, SF))
    d_cols, d_rows = duck_rows(con, E.oracle_sql()[name])
    assert s_cols == d_cols and Counter(s_rows) == Counter(d_rows)
