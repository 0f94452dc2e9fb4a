"""as-of join against pandas.merge_asof (brute-force reference) on random frames."""

import random

import pandas as pd
import pytest
from pyspark.sql import types as T

from rebuy.operators import asof_join

SCHEMA_L = T.StructType([T.StructField("g", T.StringType()), T.StructField("h", T.LongType()),
                         T.StructField("t", T.LongType()), T.StructField("lv", T.LongType())])
SCHEMA_R = T.StructType([T.StructField("g", T.StringType()), T.StructField("h", T.LongType()),
                         T.StructField("t", T.LongType()), T.StructField("rv", T.LongType()),
                         T.StructField("rn", T.DoubleType())])


def _frames(seed):
    rnd = random.Random(seed)
    left = [(rnd.choice("abc"), rnd.randint(0, 1), rnd.randint(0, 40), i) for i in range(120)]
    # right is unique per (g, h, t) so the answer is defined
    keys = {(rnd.choice("abcd"), rnd.randint(0, 1), rnd.randint(0, 40)) for _ in range(60)}
    right = [(g, h, t, i, None if i % 5 == 0 else float(i)) for i, (g, h, t) in enumerate(sorted(keys))]
    return left, right


def _pandas(left, right, by, direction, exact):
    lp = pd.DataFrame(left, columns=["g", "h", "t", "lv"])
    rp = pd.DataFrame(right, columns=["g", "h", "t", "rv", "rn"])
    if "h" not in by:
        rp = rp.drop(columns=["h"])
    out = pd.merge_asof(lp.sort_values("t"), rp.sort_values("t"), on="t", by=by, direction=direction,
                        allow_exact_matches=exact)
    rows = []
    for r in out.itertuples(index=False):
        rv = None if pd.isna(r.rv) else int(r.rv)
        rn = None if pd.isna(r.rn) else float(r.rn)
        rows.append((r.g, int(r.h), int(r.t), int(r.lv), rv, rn))
    return sorted(rows, key=repr)


@pytest.mark.parametrize("bucket", [None, 7])
@pytest.mark.parametrize("direction", ["backward", "forward", "nearest"])
@pytest.mark.parametrize("exact", [True, False])
@pytest.mark.parametrize("by", [["g"], ["g", "h"]])
def test_matches_pandas(spark, direction, exact, by, bucket):
    left, right = _frames(hash((direction, exact, len(by))) % 1000)
    lf = spark.createDataFrame(left, SCHEMA_L)
    rf = spark.createDataFrame(right, SCHEMA_R)
    if by == ["g"]:
        rf = rf.drop("h")
        right = [(g, 0, t, rv, rn) for g, h, t, rv, rn in right]
        # pandas needs unique right rows per (by, on) too
        seen, uniq = set(), []
        for row in right:
            if (row[0], row[2]) not in seen:
                seen.add((row[0], row[2]))
                uniq.append(row)
        right = uniq
        rf = spark.createDataFrame([(g, t, rv, rn) for g, _, t, rv, rn in right], "g string, t long, rv long, rn double")
    got = asof_join(lf, rf, by=by, on="t", direction=direction, allow_exact_matches=exact, bucket=bucket)
    assert got.columns == ["g", "h", "t", "lv", "rv", "rn"]
    rows = sorted([tuple(r) for r in got.collect()], key=repr)
    assert rows == _pandas(left, right, by, direction, exact)


def test_null_inside_matched_row_is_kept(spark):
    left = spark.createDataFrame([("a", 5)], "g string, t long")
    right = spark.createDataFrame([("a", 1, 10.0), ("a", 3, None)], "g string, t long, v double")
    assert [tuple(r) for r in asof_join(left, right, "g", "t").collect()] == [("a", 5, None)]


def test_dates_nearest_tie_goes_backward(spark):
    import datetime as dt

    left = spark.createDataFrame([("a", dt.date(2024, 1, 3))], "g string, d date")
    right = spark.createDataFrame([("a", dt.date(2024, 1, 1), 1), ("a", dt.date(2024, 1, 5), 2)], "g string, d date, v int")
    assert asof_join(left, right, "g", "d", "nearest").first()["v"] == 1


def test_name_clash_gets_suffix(spark):
    left = spark.createDataFrame([("a", 5, 1)], "g string, t long, v long")
    right = spark.createDataFrame([("a", 4, 9)], "g string, t long, v long")
    out = asof_join(left, right, "g", "t")
    assert out.columns == ["g", "t", "v", "v_right"]
    assert tuple(out.first()) == ("a", 5, 1, 9)


@pytest.mark.parametrize("direction", ["backward", "forward", "nearest"])
def test_bucketed_dates_equal_unbucketed(spark, direction):
    import datetime as dt

    rnd = random.Random(7)
    base = dt.date(2024, 1, 1)
    left = [("a" if i % 3 else "b", base + dt.timedelta(days=rnd.randint(0, 200))) for i in range(150)]
    right = sorted({("a" if i % 4 else "b", base + dt.timedelta(days=rnd.randint(0, 200))) for i in range(40)})
    lf = spark.createDataFrame(left, "g string, d date")
    rf = spark.createDataFrame([(g, d, i) for i, (g, d) in enumerate(right)], "g string, d date, v int")
    plain = sorted(map(tuple, asof_join(lf, rf, "g", "d", direction).collect()), key=repr)
    sliced = sorted(map(tuple, asof_join(lf, rf, "g", "d", direction, bucket=10).collect()), key=repr)
    assert plain == sliced


@pytest.mark.parametrize("direction", ["backward", "forward", "nearest"])
def test_bucketed_timestamps_equal_unbucketed(spark, direction):
    import datetime as dt

    rnd = random.Random(11)
    base = dt.datetime(2024, 1, 1)
    left = [("a" if i % 2 else "b", base + dt.timedelta(seconds=rnd.randint(0, 5000))) for i in range(120)]
    right = sorted({("a" if i % 3 else "b", base + dt.timedelta(seconds=rnd.randint(0, 5000))) for i in range(50)})
    lf = spark.createDataFrame(left, "g string, t timestamp")
    rf = spark.createDataFrame([(g, t, i) for i, (g, t) in enumerate(right)], "g string, t timestamp, v int")
    plain = sorted(map(tuple, asof_join(lf, rf, "g", "t", direction).collect()), key=repr)
    sliced = sorted(map(tuple, asof_join(lf, rf, "g", "t", direction, bucket=300).collect()), key=repr)
    assert plain == sliced


def test_supplied_left_keys_give_the_same_result(spark):
    left = spark.createDataFrame([("a", 5, 1), ("a", 9, 2), ("b", 3, 3)], "g string, t long, lv long")
    right = spark.createDataFrame([("a", 4, 10), ("a", 8, 20), ("b", 1, 30)], "g string, t long, v long")
    extra = spark.createDataFrame([("a", 5), ("a", 9), ("b", 3), ("a", 100), ("c", 1)], "g string, t long")
    plain = sorted(map(tuple, asof_join(left, right, "g", "t").collect()))
    keyed = sorted(map(tuple, asof_join(left, right, "g", "t", left_keys=extra).collect()))
    assert plain == keyed == [("a", 5, 1, 10), ("a", 9, 2, 20), ("b", 3, 3, 30)]


@pytest.mark.parametrize("direction", ["backward", "forward", "nearest"])
@pytest.mark.parametrize("bucket", [None, 7])
@pytest.mark.parametrize("reduce_left", [True, False])
def test_null_keys_take_no_part(spark, direction, bucket, reduce_left):
    left, right = _frames(11)
    expected = _pandas(left, right, ["g", "h"], direction, True)
    odd_l = [("a", 1, None, 900), (None, 1, 5, 901), ("a", None, 5, 902)]
    odd_r = [("a", 1, None, 99, 9.0), (None, 1, 5, 98, 9.0), ("a", None, 5, 97, 9.0)]
    out = asof_join(
        spark.createDataFrame(left + odd_l, SCHEMA_L),
        spark.createDataFrame(right + odd_r, SCHEMA_R),
        by=["g", "h"],
        on="t",
        direction=direction,
        bucket=bucket,
        reduce_left=reduce_left,
    )
    assert sorted((tuple(r) for r in out.collect()), key=repr) == expected


def test_a_null_on_of_the_right_side_never_matches(spark):
    left = spark.createDataFrame([("a", 5)], "g string, t long")
    right = spark.createDataFrame([("a", None, 99)], "g string, t long, v long")
    for direction in ("backward", "forward", "nearest"):
        assert asof_join(left, right, by="g", on="t", direction=direction).first().v is None


def test_repeated_left_rows_without_reduction(spark):
    left = spark.createDataFrame([("a", 5, 1), ("a", 5, 1), ("a", 7, 2)], "g string, t long, x long")
    right = spark.createDataFrame([("a", 4, 40), ("a", 6, 60)], "g string, t long, v long")
    got = asof_join(left, right, by="g", on="t", reduce_left=False)
    assert sorted(map(tuple, got.collect())) == [("a", 5, 1, 40), ("a", 5, 1, 40), ("a", 7, 2, 60)]


def test_equal_right_keys_have_an_order(spark):
    import itertools

    right_rows = [("a", 5, "first", 2), ("a", 5, "second", 1), ("a", 5, "second", 0), ("a", 9, "x", 3), ("a", 9, "w", 4), ("a", 9, None, 5)]
    left = spark.createDataFrame([("a", 1), ("a", 5), ("a", 7), ("a", 9), ("a", 12)], "k string, t int")
    by_payload = {"backward": [None, "second", "second", "x", "x"], "forward": ["first", "first", None, None, None]}
    by_tie = {"backward": [None, "first", "first", None, None], "forward": ["second", "second", "x", "x", None]}
    for rows in itertools.islice(itertools.permutations(right_rows), 0, 720, 120):
        right = spark.createDataFrame(list(rows), "k string, t int, v string, seq int").repartition(3)
        for direction in ("backward", "forward"):
            for reduce_left in (True, False):
                plain = asof_join(left, right.drop("seq"), by="k", on="t", direction=direction, reduce_left=reduce_left).orderBy("t")
                assert [r.v for r in plain.collect()] == by_payload[direction]
                tied = asof_join(left, right, by="k", on="t", direction=direction, reduce_left=reduce_left, tie="seq", bucket=4).orderBy("t")
                assert [r.v for r in tied.collect()] == by_tie[direction]
    with pytest.raises(ValueError, match="tie columns"):
        asof_join(left, right, by="k", on="t", tie="nope")
