"""Loads into two copies of one table."""

import datetime as dt

from pyspark.sql import types as T

from tidemark.operators import merge
from tidemark.operators.layout import Month

SCHEMA = T.StructType(
    [
        T.StructField("place", T.StringType()), T.StructField("day", T.DateType()),
        T.StructField("hour", T.IntegerType()), T.StructField("value", T.DoubleType()),
    ]
)
KEYS, FOLDERS = ("place", "day", "hour"), (Month("day"),)
JAN, FEB = dt.date(2024, 1, 5), dt.date(2024, 2, 5)


def load(spark, paths, rows):
    batch = spark.createDataFrame(rows, SCHEMA)
    return merge.insert_ignore_copies(batch, paths, SCHEMA, KEYS, ("value",), FOLDERS, ("hour",))


def content(spark, path):
    return sorted((tuple(r) for r in merge.read_table(spark, path, SCHEMA).collect()), key=repr)


def both(monkeypatch, spark):
    """What is gathered by a shuffle, and how often a target is compared with a batch's folders."""
    seen = []
    kind = type(spark.range(1))
    hint, narrowed = kind.hint, merge.narrowed_rows
    monkeypatch.setattr(kind, "hint", lambda df, name, *rest: seen.append(name) or hint(df, name, *rest))
    monkeypatch.setattr(merge, "narrowed_rows", lambda *given: seen.append("narrowed") or narrowed(*given))
    return seen


def test_new_rows_are_gathered_once_and_a_first_load_compares_nothing(spark, tmp_path, monkeypatch):
    paths = [f"{tmp_path}/main", f"{tmp_path}/copy"]
    seen = both(monkeypatch, spark)
    results = load(spark, paths, [("a", JAN, 1, 2.0), ("a", JAN, 1, 1.0), ("b", FEB, 2, 3.0)])
    assert seen.count("rebalance") == 1 and "narrowed" not in seen
    assert results == [merge.LoadResult(3, 2)] * 2
    for path in paths:
        assert content(spark, path) == [("a", JAN, 1, 1.0), ("b", FEB, 2, 3.0)]


def test_copies_that_know_different_keys_with_nulls_and_repeats(spark, tmp_path, monkeypatch):
    paths = [f"{tmp_path}/main", f"{tmp_path}/copy"]
    load(spark, paths[:1], [("a", JAN, 1, 1.0), ("n", JAN, None, 1.0), (None, JAN, 1, 1.0)])
    load(spark, paths[1:], [("b", FEB, 2, 1.0), ("n", JAN, None, 5.0)])
    batch = [
        ("a", JAN, 1, 9.0), ("b", FEB, 2, 9.0), ("n", JAN, None, 9.0), ("c", FEB, 3, 8.0), ("c", FEB, 3, 7.0),
        # A null outside the nullable keys equals no other.
        (None, JAN, 1, 9.0),
    ]
    for few in (merge.FEW, 0):
        # The same keys, whether the batch's keys go to every task or not: rows without a place come again.
        monkeypatch.setattr(merge, "FEW", few)
        results = load(spark, paths, batch)
        again = few == 0
        assert results == [merge.LoadResult(6, 1 if again else 3), merge.LoadResult(6, 1 if again else 3)]
    assert content(spark, paths[0]) == sorted(
        [("a", JAN, 1, 1.0), ("n", JAN, None, 1.0), (None, JAN, 1, 1.0), ("b", FEB, 2, 9.0), ("c", FEB, 3, 7.0)]
        + [(None, JAN, 1, 9.0)] * 2,
        key=repr,
    )
    assert content(spark, paths[1]) == sorted(
        [("b", FEB, 2, 1.0), ("n", JAN, None, 5.0), ("a", JAN, 1, 9.0), ("c", FEB, 3, 7.0)] + [(None, JAN, 1, 9.0)] * 2,
        key=repr,
    )


def test_an_empty_batch_leaves_both_copies(spark, tmp_path):
    paths = [f"{tmp_path}/main", f"{tmp_path}/copy"]
    assert load(spark, paths, []) == [merge.LoadResult(0, 0)] * 2
    load(spark, paths, [("a", JAN, 1, 1.0)])
    assert load(spark, paths, []) == [merge.LoadResult(0, 0)] * 2
    assert content(spark, paths[0]) == content(spark, paths[1]) == [("a", JAN, 1, 1.0)]
