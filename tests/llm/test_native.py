"""Operators that are to run on DataFrame operations alone, and joins that must not be cross joins."""

import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
NATIVE = ("op4_label_sharding", "op5_chat_format", "op8_decontamination", "op9_quality_rules")


@pytest.mark.parametrize("name", NATIVE)
def test_plans_hold_no_python(spark, name):
    plan = entry.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"))


def test_every_operator_is_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()
