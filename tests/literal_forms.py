"""The reports' pairs and windows in their literal form, to hold the scalable ones against on small rows."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from paddock.functions.exact import binary_sums, exact_mean_2dp, exact_sums
from paddock.functions.labels import sector_label
from paddock.operators.joins import semi
from paddock.plans import reports as R


def acceleration_pairs(t, session_key):
    """R2 over every pair of a sample and a lap of its driver."""
    tel, laps = (df.where(F.col("session_key") == session_key) for df in (t.telemetrys, t.laps))
    label = sector_label("date", "date_start", "duration_sector_1", "duration_sector_2", "duration_sector_3", "offset")
    pairs = R.accelerations(tel).join(semi(laps, t.telemetrys_laps, R.SD).select(*R.SD, *R.LAP_COLS), R.SD)
    return R.mean_acceleration(pairs.groupBy(*R.SD, label.alias("sector")).agg(*binary_sums("acceleration", "a")))


def tyre_pairs(t):
    """R3a over every pair of a stint and a weather row of its session."""
    st = t.tyre_stints.select("session_key", "compound", (F.col("lap_end") - F.col("lap_start")).alias("_len"))
    g = st.join(t.weather_conditions.select("session_key", "track_temperature"), "session_key").groupBy("compound").agg(
        *exact_sums("track_temperature", "tt"), F.max("_len").cast("int").alias("max_stint_laps"))
    return g.select("compound", exact_mean_2dp("tt").alias("mean_track_temperature"), "max_stint_laps")


def temperature_pairs(t, session_key):
    """R5 over every pair of a sample and a weather row of its session."""
    tel, wc = (df.where(F.col("session_key") == session_key) for df in (t.telemetrys, t.weather_conditions))
    g = (tel.select(*R.SD, "speed", "throttle").join(t.drivers.select(*R.SD, "full_name"), R.SD)
         .join(wc.select("session_key", "track_temperature"), "session_key").join(t.sessions.select("session_key", "circuit_short_name"), "session_key")
         .groupBy("circuit_short_name", "full_name")
         .agg(*exact_sums("speed", "sp"), *exact_sums("throttle", "th"), *exact_sums("track_temperature", "tt")))
    return g.select("circuit_short_name", "full_name", exact_mean_2dp("sp").alias("mean_speed"), exact_mean_2dp("th").alias("mean_throttle"),
                    exact_mean_2dp("tt").alias("mean_track_temperature"))


def runs_by_windows(t):
    """R4 with the entry and exit speed from windows over each run."""
    runs = R.drs_state_runs(t, buckets=None)
    run = Window.partitionBy(*R.SD, "run_id").orderBy("date")
    whole = run.rangeBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = runs.select(*R.SD, "run_id", *R.RUN_STATES, "date", F.first("speed").over(run).alias("start_value"), F.last("speed").over(whole).alias("end_value"))
    return R.named_runs(t, ends.groupBy(*R.SD, "run_id", *R.RUN_STATES, "start_value", "end_value").agg(
        F.min("date").alias("start_time"), F.max("date").alias("end_time")))
