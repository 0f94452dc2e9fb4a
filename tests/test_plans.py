"""Plan audit as a test: no registered query may run Python in a plan, join
without keys, or move unaggregated rows into a single partition. The plans of
all stage tables that a query writes on its way are audited like its result's,
those of the model queries too."""

import os
import re
import sys

import pytest

from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))
import __spark_entry__ as entry  # noqa: E402
from rebuy.operators import asof_join  # noqa: E402
from rebuy.sources import coerce_transactions  # noqa: E402
from plan_report import FLAGS, plan_text, single_partition  # noqa: E402

from pyspark.sql import DataFrameWriter  # noqa: E402


@pytest.mark.parametrize("name", sorted(entry.QUERIES))
def test_plan_has_no_python_cartesian_or_single_partition(spark, name, monkeypatch):
    plans = []
    write = DataFrameWriter.parquet

    def audited(self, *args, **kwargs):
        plans.append(plan_text(self._df))
        return write(self, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", audited)
    plans.append(plan_text(entry.QUERIES[name](spark, SF_SMALL)))
    for text in plans:
        assert not [k for k, rx in FLAGS.items() if rx.search(text)]
        assert "single_partition" not in single_partition(text)


def test_the_pair_table_is_shuffled_three_times(spark, monkeypatch):
    """On (customer, article) for its history, on the customer and on the article; the daily aggregate comes before."""
    import re

    from rebuy.plans import features

    keys = lambda text: [re.sub(r"#\d+L?", "", k) for k in re.findall(r"Exchange hashpartitioning\(([^)]*?), \d+\)", text)]
    staged = {}
    stage = features.stage_table

    def told(df, name):
        staged[name] = keys(plan_text(df))
        return stage(df, name)

    monkeypatch.setattr(features, "stage_table", told)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        result = keys(plan_text(features.build_dataset(entry._tx(spark, SF_SMALL))))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    daily, history = "customer_id, article_id, order_date", "customer_id, article_id"
    assert [k for k in staged["pair_history"] if k in (daily, history)] == [history, daily]  # the last one first
    # Both sides of the two joins; none of them by day.
    assert sorted(result) == ["article_id", "article_id", "customer_id", "customer_id"]


@pytest.mark.parametrize("direction", ["forward", "nearest"])
def test_asof_windows_go_over_a_group_once(spark, direction):
    """No frame that ends at the group's end: Spark goes through those once per row."""
    left = spark.createDataFrame([("a", 3), ("a", 5)], "k string, t int")
    right = spark.createDataFrame([("a", 1, "x"), ("a", 4, "y"), ("a", 4, "z"), ("a", 9, None)], "k string, t int, v string")
    for reduce_left in (True, False):
        out = asof_join(left, right, by="k", on="t", direction=direction, bucket=100, reduce_left=reduce_left)
        frames = re.findall(r"specifiedwindowframe\(RowFrame, (\S+), (\S+?)\)", out._jdf.queryExecution().optimizedPlan().toString())
        assert frames and ("currentrow$()", "unboundedfollowing$()") not in frames
        assert [(r.t, r.v) for r in out.orderBy("t").collect()] == ([(3, "y"), (5, None)] if direction == "forward" else [(3, "y"), (5, "z")])


@pytest.mark.parametrize("name", ["asof_backward_pair", "asof_nearest", "asof_forward"])
def test_asof_queries_join_the_tables_once(spark, name):
    plan = entry.queries()[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" not in plan and "o_custkey" not in plan


def test_the_first_tree_builds_its_rows_once(spark, monkeypatch):
    seen, fit = [], entry.fit
    monkeypatch.setattr(entry, "fit", lambda rows, *a: seen.append(rows) or fit(rows, *a))
    entry.queries()["boost_first_tree"](spark, SF_SMALL)
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Generate" not in plan


def test_each_text_is_parsed_once(spark):
    raw = spark.range(3).selectExpr("CAST(id AS STRING) customer_id", "'a' article_id", "concat('2024-05-0', id) order_date", "'1' quantity")
    out = coerce_transactions(raw, day_first=False)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter" in line]
    assert filters and not any("RLIKE" in line for line in filters)
    assert plan.count("MMM d yyyy") == 1 and out.count() == 2


@pytest.mark.parametrize("name", ["features", "dataset"])
def test_candidates_are_built_by_compiled_code(spark, name):
    """A lambda is interpreted, and the rows around it are copied with the arrays that it reads."""
    assert "lambdafunction" not in plan_text(entry.QUERIES[name](spark, SF_SMALL))


def test_static_attributes_are_counted_before_the_percentile(spark):
    """Many pairs with few gaps: the percentile of an article gets a row per distinct gap and month, not one per pair."""
    import datetime as dt

    from rebuy.operators.articles import article_static_from_pairs
    from rebuy.operators.interactions import daily_lines, pair_history

    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(n)
    rows = [(f"c{c}", "a", day(d), 1) for c in range(40) for d in (0, 10, 10, 40)]
    rows += [("c1", "b", day(40), 1), ("c1", "b", day(5), 1), ("c2", "once", day(70), 2)]
    tx = spark.createDataFrame(rows, "customer_id string, article_id string, order_date date, quantity bigint")
    static = article_static_from_pairs(pair_history(daily_lines(tx)))
    found = {r["article_id"]: (r["article_median_repurchase_days"], r["article_peak_month"]) for r in static.collect()}
    # Gaps of a: 0, 10 and 30, 40 times each; a tie of b's months goes to the first in date order.
    assert found == {"a": (10.0, 1), "b": (35.0, 1), "once": (None, 3)}
    text = plan_text(static)
    assert re.search(r"Aggregate\(keys=\[article_id#\d+, by_month#\d+, value#\d+\]", text)
