from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import as_set, plan_of
from stratalake.operators.dedup import dedup_latest

DDL = "tenant_id string, k string, at int, v string"


def test_latest_wins_and_nulls_come_last(rows):
    df = rows(DDL, ("a", "1", 1, "old"), ("a", "1", 2, "new"), ("a", "1", None, "null"), ("b", "1", None, "x"))
    assert as_set(dedup_latest(df, ["tenant_id", "k"], "at")) == {("a", "1", 2, "new"), ("b", "1", None, "x")}


def test_ties_do_not_depend_on_row_order(rows):
    data = [("a", "1", 1, v) for v in ("p", "q", None)]
    expected = {("a", "1", 1, "q")}
    for order in (data, data[::-1]):
        assert as_set(dedup_latest(rows(DDL, *order).repartition(3), ["tenant_id", "k"], "at")) == expected


def test_hot_keys_are_reduced_before_the_shuffle(rows):
    plan = plan_of(dedup_latest(rows(DDL, ("a", "1", 1, "v")), ["tenant_id", "k"], "at"))
    physical = plan[plan.index("== Physical Plan =="):]
    exchange = physical.index("Exchange")
    assert "row_number(), 1, Partial" in physical[exchange:]  # children follow their parent
    assert "row_number(), 1, Final" in physical[:exchange]


record = st.tuples(
    st.sampled_from(["a", "b"]),
    st.sampled_from(["1", "2", None]),
    st.one_of(st.none(), st.integers(0, 3)),
    st.one_of(st.none(), st.sampled_from("xyz")),
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(record, min_size=1, max_size=25))
def test_same_as_brute_force(spark, data):
    rank = lambda x: (x is not None, x if x is not None else 0)
    text = lambda x: (x is not None, x or "")
    best: dict = {}
    for t, k, at, v in data:
        order = (rank(at), text(v))
        if (t, k) not in best or order > best[t, k][0]:
            best[t, k] = (order, (t, k, at, v))
    df = spark.createDataFrame(data, DDL)
    assert as_set(dedup_latest(df, ["tenant_id", "k"], "at")) == {row for _, row in best.values()}
