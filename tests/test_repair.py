import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from pacecast.operators import repair

SCHEMA = "k int, y_med_raw array<double>, y_upper_raw array<double>, y_lower_raw array<double>"


def by_hand(med, upper, lower):
    """The repair in plain words: never below the first median, never falling, bands on their side."""
    top, out = med[0], []
    for m, u, v in zip(med, upper, lower):
        shifted = u + max(m, med[0]) - abs(m)
        top = max(top, m)
        out.append((top, max(shifted, top), min(v, top)))
    return out


def random_paths(n, seed):
    rnd = random.Random(seed)

    def path(size):
        return [round(rnd.uniform(-50, 200), 3) for _ in range(size)]

    sizes = [rnd.randint(1, 12) for _ in range(n)]
    return [(i, path(s), path(s), path(s)) for i, s in enumerate(sizes)]


def test_array_form_against_loop(spark):
    paths = random_paths(200, 3)
    for r in repair.repair_arrays(spark.createDataFrame(paths, SCHEMA)).collect():
        want = by_hand(r.y_med_raw, r.y_upper_raw, r.y_lower_raw)
        got = list(zip(r.y_med, r.y_upper, r.y_lower))
        assert [pytest.approx(w) for w in want] == got


def test_long_form_equals_array_form(spark):
    wide = repair.repair_arrays(spark.createDataFrame(random_paths(60, 4), SCHEMA))
    long = wide.select(
        "k", F.posexplode(F.arrays_zip("y_med_raw", "y_upper_raw", "y_lower_raw", "y_med", "y_upper", "y_lower"))
    ).select("k", F.col("pos").alias("day_index"), "col.*")
    plain = long.select(
        "k", "day_index", *[F.col(f"{c}_raw").alias(c) for c in ("y_med", "y_upper", "y_lower")]
    )
    columns = ("k", "day_index", "y_med", "y_upper", "y_lower")
    a = sorted(map(tuple, repair.repair_rows(plain, ["k"]).select(*columns).collect()))
    b = sorted(map(tuple, long.select(*columns).collect()))
    assert [pytest.approx(x) for x in a] == b


@settings(max_examples=5, deadline=None)
@given(st.integers(0, 10_000))
def test_bands_are_ordered_and_medians_never_fall(spark, seed):
    for r in repair.repair_arrays(spark.createDataFrame(random_paths(50, seed), SCHEMA)).collect():
        assert all(a <= b for a, b in zip(r.y_med, r.y_med[1:]))
        assert all(lo <= m <= up for lo, m, up in zip(r.y_lower, r.y_med, r.y_upper))


def test_raw_paths_stay_raw_and_gaps_fill(spark):
    df = spark.createDataFrame([(1, [5.0, None, 9.0], [6.0, 6.0, 6.0], [9.0, 1.0, 1.0])], SCHEMA)
    r = repair.repair_arrays(df).first()
    assert r.y_med_raw == [5.0, None, 9.0] and r.y_lower_raw == [9.0, 1.0, 1.0]
    assert r.y_med == [5.0, 7.0, 9.0] and r.y_lower == [5.0, 1.0, 1.0]


def test_capacity(spark):
    df = spark.createDataFrame([(1, [5.0, 20.0], [30.0, 30.0], [1.0, 15.0])], SCHEMA)
    capped = repair.repair_arrays(df.withColumn("rooms", F.lit(10)), "rooms").first()
    assert (capped.y_med, capped.y_upper, capped.y_lower) == ([5.0, 10.0], [10.0, 10.0], [1.0, 10.0])
    with pytest.raises(PySparkException, match="available_rooms"):
        repair.repair_arrays(df.withColumn("rooms", F.lit(None).cast("int")), "rooms", strict=True).collect()
    assert set(repair.repair_arrays(df.withColumn("rooms", F.lit(None).cast("int")), "rooms").first().y_med) == {None}


def test_fill_rows_copies_ends(spark):
    df = spark.createDataFrame([("p", i, v) for i, v in enumerate([None, 2.0, None, None, 8.0, None])],
                               "k string, i int, y double")
    got = [r.y for r in repair.fill_rows(df, ["k"], "i", "y").orderBy("i").collect()]
    assert got == [2.0, 2.0, 4.0, 6.0, 8.0, 8.0]
