"""The driver contract and a sample of registered queries against their
DuckDB oracle at sf0.001 (the full set runs in tools/oracle_check.py)."""

import duckdb
import pyarrow as pa
import pytest

import __spark_entry__ as E
from delaylens.sources.tables import TABLES, table_path
from tools.oracle_check import table_rows

SF = "/root/testdata/sf0.001"
SAMPLE = ["route_stats", "top_routes", "preprocess_complete", "missing_report", "ks_2samp", "mann_whitney_u",
          "interpolate_linear", "average_precision", "pr_curve", "group_stats_rich", "busiest_routes",
          "month_year_pivot", "histogram", "label_encode", "cause_report", "high_risk_groups"]


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and {"Ranking", "Rank", "Route"} <= set(df.columns)


def test_every_oracle_has_a_query():
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF, t)}')")
    return c


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, con, name):
    st = E.queries()[name](spark, SF).toArrow()
    ot = con.sql(E.oracle_sql()[name]).to_arrow_table()
    assert st.num_rows == ot.num_rows
    assert sorted(st.column_names) == sorted(ot.column_names)
    assert table_rows(st, 9) == table_rows(ot, 9)
