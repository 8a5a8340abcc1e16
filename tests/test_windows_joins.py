import random

from pyspark.sql import functions as F

from helpers import at, rows, same
from paddock.functions.labels import sector_reach
from paddock.functions.timefn import plus_seconds
from paddock.operators.joins import _cell_join, interval_join
from paddock.operators.ranges import quantile_ranges
from paddock.operators.windows import best_row, islands, run_summary, with_previous

KEYS = ["session_key", "driver_number"]


def _states(spark, data):
    return spark.createDataFrame([(1, d, at(t), s, float(v)) for d, t, s, v in data],
                                 "session_key int, driver_number int, date timestamp_ntz, st string, v double")


def test_run_ids_and_null_state(spark):
    df = _states(spark, [(1, 0, "A", 1), (1, 1, "A", 2), (1, 2, "B", 3), (1, 3, "B", 4), (1, 4, "A", 5)])
    assert [r[0] for r in rows(islands(df, KEYS, "date", ["st"]).select("run_id", "date"), "date")] == [1, 1, 2, 2, 3]
    df = _states(spark, [(1, 0, "A", 1), (1, 1, None, 2), (1, 2, "A", 3), (1, 3, "A", 4)])
    # a null state starts a run and so does the row after it
    assert [r[0] for r in rows(islands(df, KEYS, "date", ["st"]).select("run_id", "date"), "date")] == [1, 2, 3, 3]


def test_interleaved_drivers_partitioned(spark):
    df = _states(spark, [(1, 0, "A", 1), (2, 1, "A", 2), (1, 2, "A", 3), (2, 3, "A", 4)])
    got = rows(islands(df, KEYS, "date", ["st"]).select("driver_number", "run_id"), "driver_number", "run_id")
    assert got == [(1, 1), (1, 1), (2, 1), (2, 1)]


def _random_states(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    data = []
    for i in range(n):
        d = rnd.choice([1, 2, 3])
        t = rnd.uniform(0, 6 * 3600)
        data.append((d, t, rnd.choice(["A", "B", None]) if rnd.random() < 0.9 else None, rnd.uniform(0, 300)))
    return _states(spark, data).dropDuplicates(["session_key", "driver_number", "date"])


def test_bucketed_islands_equal_unbucketed(spark):
    df = _random_states(spark)
    a = islands(df, KEYS, "date", ["st"])
    b = islands(df, KEYS, "date", ["st"], buckets=600)
    assert same(a, b)
    sa = run_summary(a, KEYS, "run_id", "date", "v", ["st"])
    sb = run_summary(b, KEYS, "run_id", "date", "v", ["st"])
    assert same(sa, sb)


def test_bucketed_lag_equals_plain_lag(spark):
    df = _random_states(spark)
    a = with_previous(df, KEYS, "date", ["date", "v"])
    b = with_previous(df, KEYS, "date", ["date", "v"], buckets=900)
    assert same(a, b)


def test_best_row_nulls_last_and_tiebreak(spark):
    df = spark.createDataFrame([(1, 1, 1, None), (1, 1, 2, 90.0), (1, 1, 3, 90.0), (1, 2, 1, None)],
                               "session_key int, driver_number int, lap_number int, lap_duration double")
    got = rows(best_row(df, KEYS, [F.col("lap_duration").asc_nulls_last(), F.col("lap_number")]), "driver_number")
    assert got == [(1, 1, 2, 90.0), (1, 2, 1, None)]


def _brute_force_join(samples, intervals):
    out = []
    for s in samples:
        for iv in intervals:
            if s[0] == iv[0] and s[1] == iv[1] and iv[2] is not None and iv[3] is not None and iv[2] <= s[2] <= iv[3]:
                out.append((s[0], s[1], s[2], iv[4]))
    return sorted(out)


def test_interval_join_matches_brute_force(spark):
    rnd = random.Random(3)
    samples = [(1, rnd.choice([1, 2]), at(rnd.uniform(0, 20000))) for _ in range(400)]
    intervals = []
    for k in range(30):
        lo = rnd.uniform(0, 20000)
        hi = None if k % 10 == 0 else lo + rnd.uniform(0, 3000)
        intervals.append((1, rnd.choice([1, 2]), at(lo), at(hi) if hi is not None else None, k))
    s = spark.createDataFrame(samples, "session_key int, driver_number int, date timestamp_ntz")
    iv = spark.createDataFrame(intervals, "session_key int, driver_number int, lo timestamp_ntz, hi timestamp_ntz, "
                                          "id int")
    want = _brute_force_join(samples, intervals)
    for b in (None, 600, 7200):
        j = interval_join(s, iv.withColumnRenamed("lo", "a").withColumnRenamed("hi", "z"), KEYS, "date",
                          F.col("a"), F.col("z"), b)
        got = sorted(tuple(r) for r in j.select(*KEYS, "date", "id").collect())
        assert got == want, b


def test_a_very_long_interval_makes_two_cells(spark):
    samples = [(1, 1, at(t)) for t in range(0, 50_000, 500)]
    s = spark.createDataFrame(samples, "session_key int, driver_number int, date timestamp_ntz")
    laps = [(1, 1, 0.0, 90.0, 1), (1, 1, 100.0, 1e11, 2), (1, 1, 49_000.0, 4e4, 3), (1, 1, 20_000.0, -5.0, 4), (1, 1, 500.0, 0.0, 5), (1, 1, 700.0, None, 6)]
    iv = spark.createDataFrame([(a, b, at(c), d, e) for a, b, c, d, e in laps], "session_key int, driver_number int, lo timestamp_ntz, d double, id int")
    hi = plus_seconds("lo", F.col("d"))
    want = sorted((id_, t) for _, _, lo, d, id_ in laps for _, _, t in samples if d is not None and at(lo) <= t and t.timestamp() <= at(lo).timestamp() + d)
    ranges = quantile_ranges(s, KEYS, "date", rows=10)
    for b in (None, 1, 60, 3600, ranges):
        j = interval_join(s, iv, KEYS, "date", F.col("lo"), hi, b)
        assert sorted((r.id, r.date) for r in j.select("id", "date").collect()) == want, b
    # what the long lap explodes into: two cells at most, or the driver's own ranges
    made = _cell_join(s, iv.select("*", F.col("lo").alias("_lo"), hi.alias("_hi")), KEYS, "date", 1).where("id = 2")
    assert made.select("_level", "_cell").distinct().count() <= 2


def _bursts(spark):
    """Driver 1: a quiet hour with 4000 samples in one of its seconds; driver 2: few; driver 3: spread; driver 4: one sample."""
    data = [(1, t, "AB"[t % 7 == 0], t) for t in range(0, 3600, 60)]
    data += [(1, 1800.5 + i / 10_000, "AB"[(i // 13) % 2], i) for i in range(4000)]
    data += [(2, t, "A", t) for t in range(5)] + [(3, t * 11, "AB"[t % 2], t) for t in range(900)] + [(4, 7, None, 1)]
    return _states(spark, data).repartition(4)


def test_ranges_cut_a_burst_and_results_stay(spark):
    df = _bursts(spark)
    ranges = quantile_ranges(df, KEYS, "date", rows=100)
    sizes = ranges.numbered(df, F.col("date"), "_b").groupBy(*KEYS, "_b").count()
    assert sizes.agg(F.max("count")).first()[0] <= 250
    assert {r.driver_number: r.n for r in sizes.groupBy("driver_number").agg(F.count("*").alias("n")).collect()}.keys() == {1, 2, 3, 4}
    assert sizes.where("driver_number in (2, 4)").agg(F.max("_b")).first()[0] == 0
    assert same(with_previous(df, KEYS, "date", ["date", "v"]), with_previous(df, KEYS, "date", ["date", "v"], buckets=ranges))
    a, b = islands(df, KEYS, "date", ["st"]), islands(df, KEYS, "date", ["st"], buckets=ranges)
    assert same(a, b)


def test_no_ranges_where_no_key_needs_them(spark):
    assert quantile_ranges(_bursts(spark), KEYS, "date", rows=5000) is None
    assert quantile_ranges(_bursts(spark).where("false"), KEYS, "date", rows=1) is None


def test_ranges_joined_over_salts(spark, monkeypatch):
    from paddock.operators import ranges as module
    df = _bursts(spark)
    cuts = quantile_ranges(df, KEYS, "date", rows=200)
    a = cuts.numbered(df, F.col("date"), "n")
    monkeypatch.setattr(module, "BROADCAST_CUTS", 0)
    assert same(a, cuts.numbered(df, F.col("date"), "n"))


def test_strict_reach_is_reference_window(spark):
    df = spark.createDataFrame([(at(0), 10.0, 20.0, 30.0)], "s timestamp_ntz, d1 double, d2 double, d3 double")
    lo, hi = sector_reach(F.col("s"), F.col("d1"), F.col("d2"), F.col("d3"), "strict")
    assert tuple(df.select(lo, hi).first()) == (at(0), at(60))


def test_suggest_bucket_seconds(spark):
    from paddock.operators.windows import suggest_bucket_seconds
    df = spark.createDataFrame([(1, 1, at(t)) for t in range(0, 10000)] + [(1, 2, at(t)) for t in range(0, 100)],
                               "session_key int, driver_number int, date timestamp_ntz")
    b = suggest_bucket_seconds(df, KEYS, "date")
    assert 90 <= b <= 110  # 10k rows over ~10k s: about 100 rows per bucket
