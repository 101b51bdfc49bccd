"""Plans as they should be: no Python in the tasks, no nested loops, pushed filters, few shuffles."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from ticketlens.checks import features, histories, scores, selection, training
from ticketlens.fixtures import fixture, table
from ticketlens.operators import history, ledger, prepare, profile, score, snapshots

SF_DIR = "/root/testdata/sf0.001"
FORBIDDEN = ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow", "FlatMapGroups", "CartesianProduct", "BroadcastNestedLoopJoin")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df) -> int:
    return len(re.findall(r"Exchange (?:hash|range|single|round)", plan_of(df)))


# fitted models end in plans of their own; the training-data operators have tests of their own beside them
PLANNED = sorted(set(entry.oracle_sql()).intersection(
    n for m in (features, histories, scores, selection, training) for n in m.QUERIES
))


@pytest.mark.parametrize("name", PLANNED)
def test_no_python_and_no_nested_loops(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF_DIR))
    assert not [w for w in FORBIDDEN if w in plan]


def test_scoring_is_one_narrow_stage(spark):
    rows = fixture(spark, SF_DIR, "fx_predictions")
    assert shuffles(score.score(rows)) == shuffles(rows)


def test_states_shuffle_the_log_once(spark, tmp_path):
    schema = "key string, changed_at timestamp_ntz, history_id long, item_ord int, header string, before string"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/log")
    spark.createDataFrame([], "key string, created timestamp_ntz, a string").write.parquet(f"{tmp_path}/now")
    built = history.states(spark.read.parquet(f"{tmp_path}/now"), spark.read.parquet(f"{tmp_path}/log"), ["a"])
    # the changes and the current tickets, each by key; nothing after their union
    assert shuffles(built) == 2 and plan_of(built).index("Union") < plan_of(built).index("Exchange")
    # the days of a key stay where its states are
    assert shuffles(snapshots.daily_last(built)) == 2


def test_tag_lists_shuffle_the_log_once(spark, tmp_path):
    schema = "key string, header string, changed_at timestamp_ntz, history_id long, item_ord int, before string, after string"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/log")
    spark.createDataFrame([], "key string, header string, value string").write.parquet(f"{tmp_path}/now")
    assert shuffles(history.replay_list(spark.read.parquet(f"{tmp_path}/now"), spark.read.parquet(f"{tmp_path}/log"))) == 1


def test_filter_and_columns_reach_the_scan(spark):
    orders = table(spark, SF_DIR, "orders").select(F.col("o_orderdate").alias("extract_date"), "o_custkey", "o_totalprice")
    plan = plan_of(prepare.since(prepare.parse_day(orders), "1996-01-01").select("o_custkey"))
    assert re.search(r"PushedFilters: \[.*o_orderdate", plan) and "o_totalprice" not in plan.split("ReadSchema")[1]


def test_top_values_are_limited_before_the_shuffle(spark):
    counts = profile.value_counts(fixture(spark, SF_DIR, "fx_items"), ["c_topk", "c_high"])
    assert "WindowGroupLimit" in plan_of(profile.most_frequent(counts, "value", 10))


def test_small_batch_does_not_shuffle_the_ledger(spark, tmp_path):
    rows = spark.createDataFrame([(i, "m", 1) for i in range(100)], "epic_key int, model_name string, v int")
    rows.write.parquet(f"{tmp_path}/old")
    rows.limit(3).write.parquet(f"{tmp_path}/new")
    merged = ledger.upsert(spark.read.parquet(f"{tmp_path}/old"), spark.read.parquet(f"{tmp_path}/new"), old_unique=True)
    merged.collect()
    final = merged._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "BroadcastHashJoin" in final and "LeftAnti" in final
