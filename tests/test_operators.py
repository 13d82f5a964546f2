from __future__ import annotations

import itertools
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from siltstone import operators as op


def test_top_row_is_independent_of_partitioning(spark):
    data = [(k, 1, payload) for k in range(20) for payload in "dbca"]
    picks = set()
    for parts in (1, 3, 7):
        random.Random(parts).shuffle(data)
        df = spark.createDataFrame(data, "k int, t int, payload string").repartition(parts)
        picks.add(tuple(rows(op.top_row(df, ["k"], ["t"]))))
    assert len(picks) == 1
    assert {payload for _, _, payload in picks.pop()} == {"a"}


def test_top_row_skips_columns_without_an_order(spark):
    df = spark.createDataFrame([(1, {"a": 1}, 2), (1, {"a": 1}, 1)], "k int, m map<string,int>, v int")
    assert op.top_row(df, ["k"]).select("v").collect()[0].v == 1


def test_null_keys_are_one_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 3)], "k int, v int")
    assert rows(op.top_row(df, ["k"], [F.desc("v")])) == [(None, 2), (1, 3)]


def test_keep_known_neither_multiplies_nor_matches_null(spark):
    facts = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    known = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert rows(op.keep_known(facts, known, ["k"])) == [(1, "a")]


def test_membership_neither_multiplies_nor_leaves_null(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    members = spark.createDataFrame([(1,), (1,)], "k int")
    assert rows(op.membership(df, members, ["k"], "flag")) == [(None, False), (1, True), (2, False)]


def test_zero_fill_leaves_other_columns_null(spark):
    dimension = spark.createDataFrame([(1,), (2,)], "k int")
    measures = spark.createDataFrame([(1, 5, "x")], "k int, n int, first string")
    filled = op.zero_fill_join(dimension, measures, ["k"], {"n": 0})
    assert rows(filled) == [(1, 5, "x"), (2, 0, None)]


def test_join_sides_must_not_share_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    with pytest.raises(ValueError, match="both join sides"):
        op.join_pairs(df, df, {"a": "b"})


@pytest.mark.parametrize("tolerance", [0.01, 0.5, 3.0])
def test_tolerance_join_equals_brute_force(spark, tolerance):
    generator = random.Random(11)
    special = [0.0, -0.005, 0.005, 0.08, 0.07999999999999999, 0.09, 1e15, 1e15 + 0.125, None, float("nan"), float("inf")]
    left = [(k, v) for k in "ab" for v in special + [generator.uniform(-4, 4) for _ in range(60)]]
    right = [(k, v) for k in "bc" for v in special + [generator.uniform(-4, 4) for _ in range(60)]]
    left += [("b", v + d) for _, v in right[:40] if v is not None for d in (tolerance, -tolerance)]
    ldf = spark.createDataFrame([(i, *r) for i, r in enumerate(left)], "i int, lk string, lv double")
    rdf = spark.createDataFrame([(j, *r) for j, r in enumerate(right)], "j int, rk string, rv double")
    found = op.tolerance_join(ldf, rdf, {"lk": "rk"}, "lv", "rv", tolerance).select("i", "j").collect()
    expected = [
        (i, j)
        for (i, (lk, lv)), (j, (rk, rv)) in itertools.product(enumerate(left), enumerate(right))
        if lk == rk and lv is not None and rv is not None and abs(rv - lv) < tolerance
    ]
    assert expected
    assert sorted(map(tuple, found)) == expected


def test_union_tagged_goes_by_name(spark):
    first = spark.createDataFrame([(1, "a")], "n int, s string")
    second = spark.createDataFrame([("b", 2)], "s string, n int")
    assert rows(op.union_tagged({"x": first, "y": second})) == [(1, "a", "x"), (2, "b", "y")]


def check(df) -> int:
    (row,) = df.collect()
    return row.passed


def test_single_key_check_fails_on_null_and_on_duplicates(spark):
    def frame(*values):
        return spark.createDataFrame([(v,) for v in values], "k int")

    assert check(op.keys_unique(frame(1, 2), ["k"])) == 1
    assert check(op.keys_unique(frame(1, 1), ["k"])) == 0
    assert check(op.keys_unique(frame(1, None), ["k"])) == 0


def test_composite_key_check_counts_null_as_a_value(spark):
    schema = "a int, b int"
    assert check(op.keys_unique(spark.createDataFrame([(1, None), (1, 2)], schema), ["a", "b"])) == 1
    assert check(op.keys_unique(spark.createDataFrame([(1, None), (1, None)], schema), ["a", "b"])) == 0


def test_null_ratio(spark):
    def frame(missing, total):
        data = [(None if i < missing else "v",) for i in range(total)]
        return spark.createDataFrame(data, "version_id string")

    assert check(op.null_ratio_below(frame(0, 0), "version_id", 0.30)) == 1
    assert check(op.null_ratio_below(frame(2, 10), "version_id", 0.30)) == 1
    assert check(op.null_ratio_below(frame(3, 10), "version_id", 0.30)) == 0


def test_enforce_raises(spark):
    op.enforce(op.has_rows(spark.range(1)), "some rows")
    with pytest.raises(op.CheckFailed, match="no rows"):
        op.enforce(op.has_rows(spark.range(0)), "no rows")
