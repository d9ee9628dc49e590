"""What the plans must look like to hold at scale."""

import os
import re
from pathlib import Path

import pytest

from panelspark.operators.filters import in_month_list
from panelspark.operators.monthly import monthly_wide
from workload import standins as S
from workload.catalog import QUERIES

ROOT = Path(__file__).resolve().parent.parent
needs_tables = pytest.mark.skipif(not os.path.isdir("/root/testdata"), reason="needs the test tables")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@needs_tables
@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.endswith("_run")))
def test_no_cross_join_no_python_rows(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert not re.search(r"CartesianProduct|NestedLoopJoin|EvalPython|MapInPandas|FlatMapGroups", plan)


@needs_tables
def test_monthly_sums_push_filters_read_few_columns_and_shuffle_once(spark, sf_dir):
    rows = in_month_list(S.scoped(spark, sf_dir), [(1999, 1), (1999, 2)], S.FACT)
    df = monthly_wide(rows, S.FACT)
    text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    pushed = re.search(r"PushedFilters: \[(.*)\]", text).group(1)
    for part in ("In(l_linenumber", "Not(EqualTo(l_suppkey,7))", "GreaterThanOrEqual(l_shipdate", "LessThan(l_shipdate"):
        assert part in pushed
    schema = re.search(r"ReadSchema: struct<(.*)>", text).group(1)
    assert len(schema.split(",")) == 5
    plan = plan_of(df)
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_sum" in plan and "partial_bit_or" in plan and "SortAggregate" not in plan


@needs_tables
def test_panel_scans_the_fact_once(spark, sf_dir):
    """After the sums are stored, the panel reads only them and the ids."""
    df = QUERIES["dense_station_panel"](spark, sf_dir)
    assert "lineitem" not in plan_of(df)


def test_sources_keep_the_rules():
    code = "\n".join(p.read_text() for p in [*ROOT.glob("panelspark/**/*.py"), *ROOT.glob("workload/*.py")])
    for banned in ("localCheckpoint", "crossJoin", ".rdd", "toPandas", "@udf", "pandas_udf", "coalesce(1)"):
        assert banned not in code
