"""The end-to-end reports (R0-R6), each a function of ``Tables`` returning a DataFrame.

The reference hard-codes one race session and one driver; here they are
parameters. Output columns are English snake_case; label values keep the
reference's text. Means don't depend on the order of summation and nothing is
rounded before it is summed (see ``paddock.functions.exact``).

Scale notes, per report:

* R1/R4 join samples to laps with ``interval_join`` (equi key + time bucket +
  range residual) and aggregate with partial aggregation.
* R2 never materialises its samples x laps fan-out: labelled pairs come from an
  interval join and the unlabelled (NULL sector) group is derived from per-driver
  totals times the lap count.
* R3/R5 pre-aggregate each side of their many-to-many join per session and then
  weight by the other side's row count (G1).
* Ordered windows (lag, islands) run per (keys, range): drivers with very many samples are cut at quantiles of their own
  times (``buckets="auto"``), so they are spread over many tasks. Interval joins that no window follows
  use dyadic cells.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paddock.functions.exact import (binary_mean, binary_rest, binary_sums, binary_totals, exact_mean, exact_mean_2dp, exact_sums,
                                     weighted_sums)
from paddock.functions.labels import (brake_state, drs_state, instant_acceleration, sector_label,
                                      sector_reach)
from paddock.operators.joins import DEFAULT_BUCKET_SECONDS, interval_join, semi
from paddock.operators.ranges import TimeRanges
from paddock.operators.windows import best_row, islands, run_summary, with_previous
from paddock.sources.tables import Tables

SD = ["session_key", "driver_number"]
LAP_COLS = ["date_start", "duration_sector_1", "duration_sector_2", "duration_sector_3"]


def _buckets(buckets, t: Tables):
    """``buckets`` as given, or for ``"auto"`` the ranges of the telemetry of ``t``. No result depends on them."""
    return t.time_ranges() if buckets == "auto" else buckets


def _cells(buckets):
    """For joins that no window follows: dyadic cells need nothing known of the telemetry."""
    return DEFAULT_BUCKET_SECONDS if buckets == "auto" else buckets


# --------------------------------------------------------------------------- R0
def all_drivers(t: Tables) -> DataFrame:
    """Distinct (driver_number, full_name, country_code, team_name) with no nulls, by number."""
    return (t.drivers.select("driver_number", "full_name", "country_code", "team_name")
            .where(F.col("full_name").isNotNull() & F.col("country_code").isNotNull()
                   & F.col("team_name").isNotNull())
            .distinct()
            .orderBy(F.col("driver_number").asc_nulls_last()))


# --------------------------------------------------------------------------- R1
def race_laps(t: Tables, session_name: str = "Race") -> DataFrame:
    """Laps of sessions with the given name (IN-subquery as a semi join)."""
    races = t.sessions.where(F.col("session_name") == session_name)
    return semi(t.laps, races, ["session_key"])


def best_laps(laps: DataFrame) -> DataFrame:
    """One lap per (session, driver): shortest duration, nulls last, ties to the lower lap number."""
    return best_row(laps, SD, [F.col("lap_duration").asc_nulls_last(), F.col("lap_number").asc_nulls_last()])


def _speed_by_sector(samples: DataFrame, laps: DataFrame, group_extra: Sequence[str],
                     buckets: int | TimeRanges | None) -> DataFrame:
    lo, hi = sector_reach(F.col("date_start"), F.col("duration_sector_1"), F.col("duration_sector_2"),
                          F.col("duration_sector_3"), "strict")
    j = interval_join(samples.select(*SD, "date", "speed"), laps, SD, "date", lo, hi, buckets)
    sector = sector_label("date", "date_start", "duration_sector_1", "duration_sector_2", "duration_sector_3",
                          "strict")
    return j.groupBy(*SD, *group_extra, sector.alias("sector")).agg(
        *exact_sums("speed", "sp"), F.min("lap_duration").alias("_min_lap"))


def sector_speed(t: Tables, *, all_laps: bool = False, require_telemetry_laps: bool = True,
                 buckets: int | TimeRanges | str | None = "auto") -> DataFrame:
    """R1a (best lap, ``all_laps=False``) and R1b (every race lap, ``all_laps=True``).

    Mean speed of the samples in each sector of the lap (strict labels, L1); the
    column keeps the reference's name ``max_speed`` although it is an average.
    Groups are (session, driver, sector, lap_duration); groups with a null lap
    duration are dropped (the reference's ``HAVING lap_duration = MIN(lap_duration)``).
    R1a keeps only drivers listed in ``telemetrys_laps``; the existence test is
    applied to the lap side, which has the same keys and is far smaller.
    """
    buckets = _cells(buckets)
    laps = race_laps(t)
    if not all_laps:
        if require_telemetry_laps:
            laps = semi(laps, t.telemetrys_laps, SD)
        laps = best_laps(laps)
    laps = laps.select(*SD, "lap_duration", *LAP_COLS)
    g = _speed_by_sector(t.telemetrys, laps, ["lap_duration"], buckets)
    return (g.where(F.col("lap_duration").isNotNull())
            .select(*SD, "lap_duration", "sector", exact_mean("sp").alias("max_speed"))
            .orderBy(*[F.col(c).asc_nulls_last() for c in (*SD, "lap_duration", "sector")]))


def sector_speed_best_lap(t: Tables, buckets: int | TimeRanges | str | None = "auto") -> DataFrame:
    """The best-lap rewrite (row_number = 1 over race laps with a lap number).

    Output ``session_key, driver_number, best_lap_duration, sector, max_speed``;
    no HAVING, so a driver whose laps all lack a duration still shows its rank-1 lap.
    """
    buckets = _cells(buckets)
    laps = race_laps(t).where(F.col("lap_number").isNotNull())
    laps = best_laps(laps).select(*SD, "lap_duration", *LAP_COLS)
    g = _speed_by_sector(t.telemetrys, laps, [], buckets)
    return g.select(*SD, F.col("_min_lap").alias("best_lap_duration"), "sector",
                    exact_mean("sp").alias("max_speed"))


# --------------------------------------------------------------------------- R2
def accelerations(tel: DataFrame, buckets: int | TimeRanges | None = None, keep_bucket: str | None = None) -> DataFrame:
    """Instant acceleration of every sample against the previous one of the same driver."""
    p = with_previous(tel.select(*SD, "date", "speed"), SD, "date", ["date", "speed"], buckets,
                      keep_bucket=keep_bucket)
    kept = [keep_bucket] if keep_bucket and buckets else []
    return p.select(*SD, "date", *kept,
                    instant_acceleration("speed", "prev_speed", "date", "prev_date").alias("acceleration"))


def sector_acceleration(t: Tables, session_key: int | None, *, require_telemetry_laps: bool = True,
                        buckets: int | TimeRanges | str | None = "auto") -> DataFrame:
    """R2a (``require_telemetry_laps=True``) / R2b: mean acceleration per driver and sector.

    Every sample counts with every lap of its driver (no time predicate), labelled with
    the offset convention (L2); pairs outside all three sectors are the NULL sector
    group, which is part of the output. The pairs are never made: the labelled ones come
    from an interval join and are summed per driver and sector; the NULL group is the driver's
    totals times its laps, less those sums. Sums are integers, so the subtraction is exact; a NaN or an infinity
    is counted and makes the mean one, as any engine's average does.
    Output ``driver_number, session_key, sector, mean_acceleration``, ordered by the mean
    descending (nulls first), then driver.
    """
    tel = t.telemetrys
    laps = t.laps
    if session_key is not None:
        tel = tel.where(F.col("session_key") == session_key)
        laps = laps.where(F.col("session_key") == session_key)
    buckets = _buckets(buckets, t)
    kb = "_bucket" if buckets else None
    acc = accelerations(tel, buckets, keep_bucket=kb)
    if require_telemetry_laps:
        # Same keys as the lap join, so filtering the (small) lap side is equivalent and
        # leaves the samples' (keys, bucket) partitioning intact.
        laps = semi(laps, t.telemetrys_laps, SD)
    laps = laps.select(*SD, *LAP_COLS)
    label = sector_label("date", "date_start", "duration_sector_1", "duration_sector_2",
                         "duration_sector_3", "offset")
    lo, hi = sector_reach(F.col("date_start"), F.col("duration_sector_1"), F.col("duration_sector_2"),
                          F.col("duration_sector_3"), "offset")
    labelled = (interval_join(acc, laps, SD, "date", lo, hi, buckets, sample_bucket=kb)
                .select(*SD, "acceleration", label.alias("sector")).where(F.col("sector").isNotNull())
                .groupBy(*SD, "sector").agg(*binary_sums("acceleration", "a"), F.count(F.lit(1)).alias("_r")))
    inside = labelled.groupBy(*SD).agg(*binary_totals("a"), F.sum("_r").alias("_ir"))
    totals = acc.groupBy(*SD).agg(*binary_sums("acceleration", "t"), F.count(F.lit(1)).alias("_tr"))
    n_laps = laps.groupBy(*SD).agg(F.count(F.lit(1)).alias("_laps"))
    rows = (F.col("_tr") * F.col("_laps") - F.coalesce(F.col("_ir"), F.lit(0))).alias("_r")
    outside = (totals.join(n_laps, SD, "inner").join(inside, SD, "left")
               .select(*SD, F.lit(None).cast("string").alias("sector"), *binary_rest("t", "_laps", "a", "a"), rows).where(F.col("_r") > 0))
    return mean_acceleration(labelled.unionByName(outside))


def mean_acceleration(sums: DataFrame) -> DataFrame:
    """R2's output from the ``binary_sums`` ``a`` of each group."""
    return (sums.select("driver_number", "session_key", "sector", binary_mean("a").alias("mean_acceleration"))
            .orderBy(F.col("mean_acceleration").desc_nulls_first(), F.col("driver_number").asc_nulls_last()))


# --------------------------------------------------------------------------- R3
def tyre_temperature(t: Tables) -> DataFrame:
    """Per compound, mean track temperature over stint x weather pairs of the same
    session (``NUMERIC(8,2)``, exact) and the longest stint in laps.

    The mean is weighted by the fan-out (sessions with more stints weigh more);
    the longest stint only counts sessions that have weather. NULL compound is a group.
    """
    st = t.tyre_stints.select("session_key", "compound", (F.col("lap_end") - F.col("lap_start")).alias("_len"))
    wc = t.weather_conditions.select("session_key", "track_temperature")
    w = wc.groupBy("session_key").agg(*exact_sums("track_temperature", "w"))
    s = st.groupBy("session_key", "compound").agg(F.count(F.lit(1)).alias("_sr"), F.max("_len").alias("_max"))
    g = (s.join(w, "session_key").groupBy("compound")
         .agg(*weighted_sums("w", "_sr", "tt"), F.max("_max").alias("_max")))
    return (g.select("compound", exact_mean_2dp("tt").alias("mean_track_temperature"),
                     F.col("_max").cast("int").alias("max_stint_laps"))
            .orderBy(F.col("max_stint_laps").desc_nulls_first()))


def tyre_temperature_points(stints: DataFrame, weather: DataFrame) -> DataFrame:
    """R3b/R3c core: the reduce over stint x weather pairs per compound.

    ``stints`` needs (session_key, compound, lap_start, lap_end); ``weather``
    (session_key, track_temperature). Count, exact unrounded mean, and the longest
    stint as a double floored at 0.0 (the fold starts from 0.0). Sorted by it, descending.
    """
    st = stints.select("session_key", "compound",
                       (F.col("lap_end").cast("double") - F.col("lap_start").cast("double")).alias("_len"))
    w = weather.groupBy("session_key").agg(*exact_sums("track_temperature", "w"))
    s = st.groupBy("session_key", "compound").agg(F.count(F.lit(1)).alias("_sr"), F.max("_len").alias("_max"))
    g = (s.join(w, "session_key").groupBy("compound")
         .agg(*weighted_sums("w", "_sr", "tt"), F.max("_max").alias("_max")))
    return (g.select("compound", exact_mean("tt").alias("mean_track_temperature"),
                     F.greatest(F.col("_max"), F.lit(0.0)).alias("max_lap_duration"))
            .orderBy(F.col("max_lap_duration").desc()))


# --------------------------------------------------------------------------- R4
def drs_runs(t: Tables, session_key: int | None = None, driver_number: int | None = None, *,
             require_telemetry_laps: bool = True,
             buckets: int | TimeRanges | str | None = "auto") -> DataFrame:
    """Runs of equal (DRS state, sector, brake state) per driver with entry/exit speed.

    Samples are labelled against every lap of their driver with the half-open
    convention (L3) and unlabelled samples are dropped. A run starts whenever the
    state changes from the previous sample of the same driver. Rows are grouped as
    the reference does (circuit, driver name, state, run id, entry and exit speed),
    then the run id is dropped and identical rows merge (outer DISTINCT).
    ``session_key``/``driver_number`` None means all. Each run is summarised in one
    aggregate (G9).
    """
    runs = drs_state_runs(t, session_key, driver_number, require_telemetry_laps=require_telemetry_laps, buckets=buckets)
    return named_runs(t, run_summary(runs, SD, "run_id", "date", "speed", RUN_STATES))


RUN_STATES = ["drs", "sector", "brake_state"]


def drs_state_runs(t: Tables, session_key: int | None = None, driver_number: int | None = None, *,
                   require_telemetry_laps: bool = True, buckets: int | TimeRanges | str | None = "auto") -> DataFrame:
    """R4's labelled samples with the number of the run of equal states that each is in."""
    tel = t.telemetrys
    laps = t.laps
    for col, val in (("session_key", session_key), ("driver_number", driver_number)):
        if val is not None:
            tel = tel.where(F.col(col) == val)
            laps = laps.where(F.col(col) == val)
    if require_telemetry_laps:
        laps = semi(laps, t.telemetrys_laps, SD)
    laps = laps.select(*SD, *LAP_COLS)
    buckets = _buckets(buckets, t)
    lo, hi = sector_reach(F.col("date_start"), F.col("duration_sector_1"), F.col("duration_sector_2"),
                          F.col("duration_sector_3"), "halfopen")
    base = interval_join(tel.select(*SD, "date", "speed", "brake", "drs"), laps, SD, "date", lo, hi,
                         buckets, keep_bucket="_bucket" if buckets else None)
    keep = ["_bucket"] if buckets else []
    base = (base.select(*SD, "date", *keep, "speed", brake_state("brake").alias("brake_state"),
                        drs_state("drs").alias("drs"),
                        sector_label("date", "date_start", "duration_sector_1", "duration_sector_2",
                                     "duration_sector_3", "halfopen").alias("sector"))
            .where(F.col("sector").isNotNull()))
    # Same bucket as the join: with a sort-merge join the window needs no new shuffle.
    return islands(base, SD, "date", RUN_STATES, "run_id", buckets, bucket_col="_bucket" if buckets else None)


def named_runs(t: Tables, summ: DataFrame) -> DataFrame:
    """R4's output from one row per run."""
    named = (summ.join(t.drivers.select(*SD, "full_name"), SD)
             .join(t.sessions.select("session_key", "circuit_short_name"), "session_key"))
    g = (named.groupBy("circuit_short_name", "full_name", "drs", "sector", "run_id", "start_value", "end_value",
                       "brake_state")
         .agg(F.min("start_time").alias("start_time"), F.max("end_time").alias("end_time")))
    return g.select("circuit_short_name", "full_name", "start_time", "end_time", "drs", "sector", "brake_state",
                    F.col("start_value").alias("start_speed"), F.col("end_value").alias("end_speed")).distinct()


# --------------------------------------------------------------------------- R5
def temperature_speed(t: Tables, session_key: int | None) -> DataFrame:
    """Per (circuit, driver name) mean speed, mean throttle and mean track temperature
    over sample x weather pairs of the session, all ``NUMERIC(8,2)`` (exact).

    Grouped by name, not number: two numbers with one name merge.
    """
    tel = t.telemetrys
    wc = t.weather_conditions
    if session_key is not None:
        tel = tel.where(F.col("session_key") == session_key)
        wc = wc.where(F.col("session_key") == session_key)
    tel = tel.select(*SD, "speed", "throttle")
    wc = wc.select("session_key", "track_temperature")
    drv = t.drivers.select(*SD, "full_name")
    ses = t.sessions.select("session_key", "circuit_short_name")
    keys = ["circuit_short_name", "full_name"]
    ta = tel.groupBy(*SD).agg(*exact_sums("speed", "s"), *exact_sums("throttle", "h"), F.count(F.lit(1)).alias("_tr"))
    wa = wc.groupBy("session_key").agg(*exact_sums("track_temperature", "w"), F.count(F.lit(1)).alias("_wr"))
    g = (ta.join(drv, SD).join(wa, "session_key").join(ses, "session_key").groupBy(*keys)
         .agg(*weighted_sums("s", "_wr", "sp"), *weighted_sums("h", "_wr", "th"), *weighted_sums("w", "_tr", "tt")))
    return g.select(*keys, exact_mean_2dp("sp").alias("mean_speed"), exact_mean_2dp("th").alias("mean_throttle"),
                    exact_mean_2dp("tt").alias("mean_track_temperature"))


# --------------------------------------------------------------------------- R6 / J5
def sector_samples(telemetry: DataFrame, laps: DataFrame, sessions: Sequence[int] | None = None,
                   buckets: int | TimeRanges | str | None = "auto") -> DataFrame:
    """J5 + L4: samples labelled 1/2/3 by the cumulative half-open convention; unlabelled dropped.

    ``telemetry`` (session_key, driver_number, date, speed), ``laps`` (session_key,
    driver_number, date_start, duration_sector_1..3). Output: driver_number,
    session_key, sector, speed, duration_sector_1..3, date. The reference left-joins
    every lap and drops unlabelled rows afterwards; pushing the lap window into
    the join (interval join) gives the same rows.
    """
    if sessions is not None:
        telemetry = telemetry.where(F.col("session_key").isin(*sessions))
        laps = laps.where(F.col("session_key").isin(*sessions))
    buckets = _cells(buckets)
    laps = laps.select(*SD, *LAP_COLS)
    lo, hi = sector_reach(F.col("date_start"), F.col("duration_sector_1"), F.col("duration_sector_2"),
                          F.col("duration_sector_3"), "cumulative")
    j = interval_join(telemetry.select(*SD, "date", "speed"), laps, SD, "date", lo, hi, buckets)
    j = j.select("*", sector_label("date", "date_start", "duration_sector_1", "duration_sector_2",
                                   "duration_sector_3", "cumulative").alias("sector"))
    return j.where(F.col("sector").isNotNull()).select(
        "driver_number", "session_key", F.col("sector").cast("int").alias("sector"), "speed",
        "duration_sector_1", "duration_sector_2", "duration_sector_3", "date")
