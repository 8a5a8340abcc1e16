"""Independent DuckDB SQL for every registered query (the correctness oracle).

Each text restates a report's semantics in plain SQL, independently of the
Spark plans (fan-out joins and windows where the Spark side pre-aggregates or
buckets), against the stand-in telemetry views, which are inlined as CTEs over
the driver's parquet views. Sums run over integers of nine decimals (more than
the engine's fast path has), so that the order of summation doesn't matter.
"""

from __future__ import annotations

RACE = 9992

# ----------------------------------------------------------------- stand-in views
_VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "telemetrys": ((), """
  SELECT CAST(9990 + floor((extract(day FROM ts) - 1) / 5) AS INT) AS session_key,
    CAST(user_id AS INT) AS driver_number, ts AS date, value AS speed,
    CASE WHEN event_type = 'error' THEN 100 ELSE 0 END AS brake,
    CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 WHEN 'signup' THEN 8
      WHEN 'purchase' THEN 12 ELSE 14 END AS drs,
    CAST(event_id % 101 AS DOUBLE) AS throttle
  FROM events"""),
    "sessions": ((), """
  SELECT CAST(9990 + k AS INT) AS session_key, CAST(1200 + k AS INT) AS meeting_key,
    CASE WHEN k % 2 = 0 THEN 'Race' ELSE 'Practice' END AS session_name,
    n_name AS circuit_short_name
  FROM (SELECT DISTINCT CAST(floor((extract(day FROM ts) - 1) / 5) AS INT) AS k FROM events) d
  JOIN nation ON n_nationkey = k"""),
    "telemetrys_laps": (("telemetrys",), """
  SELECT DISTINCT session_key, driver_number FROM telemetrys WHERE driver_number % 10 <> 9"""),
    "laps": (("telemetrys",), """
  SELECT session_key, driver_number, CAST(lap_number AS INT) AS lap_number, date_start,
    d1 AS duration_sector_1, d2 AS duration_sector_2, d3 AS duration_sector_3,
    CASE WHEN (driver_number + lap_number) % 11 = 0 THEN NULL ELSE d1 + d2 + d3 END AS lap_duration
  FROM (SELECT session_key, driver_number, extract(day FROM date) AS lap_number,
      date_trunc('day', min(date)) AS date_start,
      CAST(15000.25 + 1000 * (driver_number % 7) AS DOUBLE) AS d1,
      CAST(22000.5 + 500 * (extract(day FROM date) % 5) AS DOUBLE) AS d2,
      CAST(38000.125 + 10 * (driver_number % 13) AS DOUBLE) AS d3
    FROM telemetrys GROUP BY session_key, driver_number, extract(day FROM date)) g"""),
    "drivers": (("telemetrys",), """
  SELECT CAST(c_custkey AS INT) AS driver_number, session_key, c_name AS full_name,
    CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE n_name END AS country_code, c_mktsegment AS team_name
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  JOIN (SELECT DISTINCT session_key, driver_number FROM telemetrys) t ON t.driver_number = c_custkey"""),
    "weather_conditions": (("telemetrys",), """
  SELECT session_key, date, 20.0 + speed / 10 AS track_temperature
  FROM telemetrys WHERE drs = 0 AND driver_number % 5 = 0"""),
    "tyre_stints": (("telemetrys",), """
  SELECT session_key, driver_number,
    CAST(row_number() OVER (PARTITION BY session_key, driver_number ORDER BY drs) AS INT) AS stint_number,
    CAST(min(extract(day FROM date)) AS INT) AS lap_start, CAST(max(extract(day FROM date)) AS INT) AS lap_end,
    CASE drs WHEN 0 THEN 'SOFT' WHEN 1 THEN 'MEDIUM' WHEN 8 THEN 'HARD' WHEN 12 THEN 'INTERMEDIATE' END AS compound
  FROM telemetrys GROUP BY session_key, driver_number, drs"""),
}


def views(*names: str) -> str:
    """``WITH`` clause defining the named stand-in views (and what they depend on)."""
    order: list[str] = []

    def add(n: str) -> None:
        for dep in _VIEWS[n][0]:
            add(dep)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    return "WITH " + ",\n".join(f"{n} AS ({_VIEWS[n][1]}\n)" for n in order) + "\n"


def secs(d: str) -> str:
    """``INTERVAL '1 second' * d`` rounded to microseconds."""
    return f"to_microseconds(CAST(round(({d}) * 1000000) AS BIGINT))"


def m2(c: str) -> str:
    """Exact ``AVG(c)::NUMERIC(8,2)`` for values with at most nine decimals."""
    s = f"sum(CAST(round(({c}) * 1e9) AS HUGEINT))"
    n = f"CAST(count({c}) AS HUGEINT)"
    return (f"CASE WHEN {n} = 0 THEN NULL ELSE CAST(sign({s}) * ((2 * abs({s}) + 10000000 * {n}) // (20000000 * {n}))"
            f" / 100.0 AS DECIMAL(8,2)) END")


def mean_exact(c: str) -> str:
    """Exact mean of values with at most nine decimals, as a double."""
    return f"CAST(sum(CAST(round(({c}) * 1e6) AS HUGEINT)) AS DOUBLE) / (CAST(count({c}) AS DOUBLE) * 1e6)"


def q2dp(c: str, p: float) -> str:
    """Exact ``percentile_cont(p)::NUMERIC(8,2)``."""
    q = f"quantile_cont(CAST(round(({c}) * 1000000) AS BIGINT), {p})"
    return f"CAST(sign({q}) * floor(abs({q}) / 10000.0 + 0.5) / 100.0 AS DECIMAL(8,2))"


# ----------------------------------------------------------------- reports
R0 = views("drivers") + """
SELECT DISTINCT driver_number, full_name, country_code, team_name
FROM drivers
WHERE full_name IS NOT NULL AND country_code IS NOT NULL AND team_name IS NOT NULL
ORDER BY driver_number ASC"""

def _r5(sessions: str) -> str:
    """Every sample counts once per weather row of its session, and the other way round."""
    return views("telemetrys", "drivers", "weather_conditions", "sessions") + f"""
, named AS (
  SELECT (SELECT any_value(circuit_short_name) FROM sessions s WHERE s.session_key = d.session_key) AS circuit_short_name,
    full_name, session_key, driver_number
  FROM drivers d WHERE {sessions} AND session_key IN (SELECT session_key FROM sessions)
), paired AS (
  SELECT circuit_short_name, full_name, speed, throttle, track_temperature
  FROM named JOIN telemetrys USING (session_key, driver_number) JOIN weather_conditions w USING (session_key)
)
SELECT circuit_short_name, full_name, {m2('speed')} AS mean_speed, {m2('throttle')} AS mean_throttle,
  {m2('track_temperature')} AS mean_track_temperature
FROM paired GROUP BY ALL"""


R5 = _r5(f"session_key = {RACE}")
R5_ALL = _r5("TRUE")


def _lap_windows(laps_rel: str, extra: str = "") -> str:
    """Per lap: start and the three cumulative sector ends (strict convention)."""
    d1, d2, d3 = "duration_sector_1", "duration_sector_2", "duration_sector_3"
    return f"""SELECT session_key, driver_number, lap_duration{extra}, date_start AS t0,
      date_start + {secs(d1)} AS t1,
      date_start + {secs(f"{d1} + {d2}")} AS t2,
      date_start + {secs(f"{d1} + {d2} + {d3}")} AS t3
    FROM {laps_rel}"""


_STRICT = """CASE WHEN s.date > w.t0 AND s.date < w.t1 THEN 'SECTOR 1'
           WHEN s.date > w.t1 AND s.date < w.t2 THEN 'SECTOR 2'
           WHEN s.date > w.t2 AND s.date <= w.t3 THEN 'SECTOR 3' END"""


def _r1(best_lap: bool, existence: bool, by_lap: bool) -> str:
    names = ["telemetrys", "laps", "sessions"] + (["telemetrys_laps"] if existence else [])
    exists = """
    AND EXISTS (SELECT 1 FROM telemetrys_laps p
                WHERE p.session_key = s.session_key AND p.driver_number = s.driver_number)""" if existence else ""
    lap_filter = "" if by_lap else " AND lap_number IS NOT NULL"
    ranked = f"""
, race_lap AS (
    SELECT l.*, row_number() OVER (PARTITION BY l.session_key, l.driver_number
                                   ORDER BY l.lap_duration ASC NULLS LAST, l.lap_number) AS pick
    FROM laps l
    WHERE l.session_key IN (SELECT session_key FROM sessions WHERE session_name = 'Race'){lap_filter}
), win AS ({_lap_windows("race_lap WHERE pick = 1" if best_lap else "race_lap")})"""
    labelled = f"""
, labelled AS (
    SELECT s.session_key, s.driver_number, w.lap_duration, s.speed, {_STRICT} AS sector
    FROM telemetrys s
    JOIN win w ON s.session_key = w.session_key AND s.driver_number = w.driver_number
      AND s.date BETWEEN w.t0 AND w.t3{exists}
)"""
    if by_lap:  # grouped by lap duration; groups without one are dropped
        tail = f"""
SELECT session_key, driver_number, lap_duration, sector, {mean_exact('speed')} AS max_speed
FROM labelled WHERE lap_duration IS NOT NULL
GROUP BY session_key, driver_number, lap_duration, sector"""
    else:
        tail = f"""
SELECT session_key, driver_number, min(lap_duration) AS best_lap_duration, sector,
  {mean_exact('speed')} AS max_speed
FROM labelled GROUP BY session_key, driver_number, sector"""
    return views(*names) + ranked + labelled + tail


R1A = _r1(best_lap=True, existence=True, by_lap=True)
R1B = _r1(best_lap=False, existence=False, by_lap=True)
R1C = _r1(best_lap=True, existence=False, by_lap=False)
# the load derives telemetrys_laps from the laps themselves, so every lap's driver is there
R1_LOADED = _r1(best_lap=True, existence=False, by_lap=True)


def _r2(existence: bool, session: str = f"session_key = {RACE}", speed: str = "speed", odd: bool = False) -> str:
    """Every pair of a sample and a lap of its driver. ``odd``: means that are no finite number are named in a column of their own."""
    keep = "SEMI JOIN telemetrys_laps USING (session_key, driver_number)" if existence else ""
    lap = "lap.date_start"
    mean = "round(favg(a) FILTER (a IS NOT NULL AND isfinite(a)), 9)"
    if odd:
        what = """CASE WHEN count(a) = 0 THEN NULL WHEN bool_or(isnan(a)) OR (bool_or(a = 'inf'::DOUBLE) AND bool_or(a = '-inf'::DOUBLE)) THEN 'NaN'
    WHEN bool_or(a = 'inf'::DOUBLE) THEN 'Infinity' WHEN bool_or(a = '-inf'::DOUBLE) THEN '-Infinity' ELSE 'finite' END"""
        mean = f"CASE WHEN bool_and(isfinite(a)) THEN {mean} END AS mean_acceleration, {what} AS kind"
    else:
        mean += " AS mean_acceleration"
    return views("telemetrys", "telemetrys_laps", "laps") + f"""
, moving AS (
    SELECT session_key, driver_number, date, v, v - lag(v) OVER prior AS dv, (epoch_us(date) - epoch_us(lag(date) OVER prior)) / 1e6 AS dt
    FROM (SELECT *, {speed} AS v FROM telemetrys WHERE {session}) s
    WINDOW prior AS (PARTITION BY session_key, driver_number ORDER BY date)
), pairs AS (
    SELECT session_key, driver_number, CASE WHEN dt = 0 THEN 0 ELSE dv / 3.6 / dt END AS a,
      CASE WHEN date BETWEEN {lap} AND {lap} + {secs('lap.duration_sector_1')} THEN 'SECTOR 1'
           WHEN date BETWEEN {lap} + {secs('1 + lap.duration_sector_1')} AND {lap} + {secs('lap.duration_sector_2')} THEN 'SECTOR 2'
           WHEN date BETWEEN {lap} + {secs('1 + lap.duration_sector_2')} AND {lap} + {secs('lap.duration_sector_3')} THEN 'SECTOR 3' END AS sector
    FROM moving {keep} JOIN laps lap USING (session_key, driver_number)
)
SELECT driver_number, session_key, sector, {mean}
FROM pairs GROUP BY ALL"""


#: Telemetry in which some speeds are no finite numbers.
ODD_SPEED = """CASE WHEN hour(date) = 3 THEN 'nan'::DOUBLE WHEN minute(date) = 7 THEN 'inf'::DOUBLE WHEN minute(date) = 11 THEN '-inf'::DOUBLE ELSE speed END"""
R2_ODD = _r2(False, "TRUE", ODD_SPEED, True)
R2A = _r2(True)
R2B = _r2(False)
R2_ALL = _r2(True, "TRUE")

# The pairs of a session, one row per stint and weather row, then per compound
R3A = views("tyre_stints", "weather_conditions") + f"""
, paired AS (
  SELECT compound, lap_end - lap_start AS laps, unnest(temperatures) AS track_temperature
  FROM tyre_stints JOIN (
    SELECT session_key, list(track_temperature) AS temperatures FROM weather_conditions GROUP BY session_key) w USING (session_key)
)
SELECT compound, {m2('track_temperature')} AS mean_track_temperature, max(laps) AS max_stint_laps
FROM paired GROUP BY compound"""

def _runs(*states: str) -> str:
    """CTEs ``stretch``: the maximal stretches of consecutive rows of ``samples`` (session_key, driver_number, date, speed and
    ``states``) that agree in all states. A row opens a stretch if the row just before it, of the same driver, doesn't agree with it;
    the stretch ends right before the next one opens."""
    driver = "session_key, driver_number"
    agree = " AND ".join(f"before.{c} = here.{c}" for c in states)
    return f"""
, line AS (
    SELECT *, row_number() OVER mine AS spot, count(*) OVER (PARTITION BY {driver}) AS spots
    FROM samples WINDOW mine AS (PARTITION BY {driver} ORDER BY date)
), opening AS (
    SELECT here.* FROM line here
    ANTI JOIN line before ON before.session_key = here.session_key AND before.driver_number = here.driver_number
      AND before.spot = here.spot - 1 AND {agree}
), extent AS (
    SELECT *, coalesce(lead(spot) OVER openings, spots + 1) - 1 AS last_spot, row_number() OVER openings AS nth
    FROM opening WINDOW openings AS (PARTITION BY {driver} ORDER BY spot)
), stretch AS (
    SELECT o.session_key, o.driver_number, o.nth, {", ".join("o." + c for c in states)}, o.date AS opened, o.speed AS speed_in,
      c.date AS closed, c.speed AS speed_out, o.last_spot - o.spot + 1 AS n
    FROM extent o JOIN line c ON c.session_key = o.session_key AND c.driver_number = o.driver_number AND c.spot = o.last_spot
)"""


def _r4(existence: bool, only: str = "TRUE") -> str:
    """The three spans of a lap each run from the end of the one before (the first from the lap's start, which it includes);
    a sample takes the first span that holds it."""
    keep = "SEMI JOIN telemetrys_laps USING (session_key, driver_number)" if existence else ""
    return views("telemetrys", "telemetrys_laps", "laps", "drivers", "sessions") + f"""
, span AS (
    SELECT session_key, driver_number, lap_number, 1 AS no, date_start - INTERVAL 1 MICROSECOND AS beyond,
      date_start + {secs('duration_sector_1')} AS upto FROM laps
    UNION ALL SELECT session_key, driver_number, lap_number, 2, date_start + {secs('duration_sector_1')}, date_start + {secs('duration_sector_2')} FROM laps
    UNION ALL SELECT session_key, driver_number, lap_number, 3, date_start + {secs('duration_sector_2')}, date_start + {secs('duration_sector_3')} FROM laps
), samples AS (
    SELECT session_key, driver_number, date, any_value(speed) AS speed, 'SETOR ' || min(no) AS sector,
      any_value(CASE WHEN drs IN (8, 10, 12, 14) THEN 'ATIVO' ELSE 'NÃO ATIVO' END) AS drs,
      any_value(CASE brake WHEN 100 THEN 'FREANDO' ELSE 'NORMAL' END) AS brake_state
    FROM telemetrys {keep} JOIN span USING (session_key, driver_number)
    WHERE {only} AND date > beyond AND date <= upto
    GROUP BY session_key, driver_number, date, lap_number
){_runs("drs", "sector", "brake_state")}
SELECT DISTINCT circuit_short_name, full_name, opened AS start_time, closed AS end_time, drs, sector, brake_state,
  speed_in AS start_speed, speed_out AS end_speed
FROM stretch JOIN drivers USING (session_key, driver_number) JOIN sessions USING (session_key)"""


R4 = _r4(True)
R4_NOJOIN = _r4(False)
R4_ONE = _r4(True, f"session_key = {RACE} AND driver_number = 30")


def all_sql() -> dict[str, str]:
    return {
        "r0_drivers": R0,
        "r1a_sector_speed": R1A,
        "r1b_sector_speed_all_laps": R1B,
        "r1c_sector_speed_best_lap": R1C,
        "r2a_sector_accel": R2A,
        "r2b_sector_accel_nojoin": R2B,
        "r2a_all_sessions": R2_ALL,
        "r2_odd_speeds": R2_ODD,
        "r3a_tyre_temp": R3A,
        "r4_one_driver": R4_ONE,
        "r5_all_sessions": R5_ALL,
        "r4_drs_runs": R4,
        "r4_drs_runs_nojoin": R4_NOJOIN,
        "r5_temp_speed": R5,
        **operator_sql(),
    }


# ----------------------------------------------------------------- point model
def _not_null(*cols: str) -> str:
    return " AND ".join(f"{c} IS NOT NULL" for c in cols)


def _cum_sector(t: str = "t.date", l: str = "l") -> str:
    s = f"{l}.date_start"
    e1 = f"({s} + {secs(f'{l}.duration_sector_1')})"
    e2 = f"({e1} + {secs(f'{l}.duration_sector_2')})"
    e3 = f"({e2} + {secs(f'{l}.duration_sector_3')})"
    return (f"CASE WHEN {t} >= {s} AND {t} <= {e1} THEN 1 WHEN {t} > {e1} AND {t} <= {e2} THEN 2 "
            f"WHEN {t} > {e2} AND {t} <= {e3} THEN 3 END")


_LABELLED = f"""
, lab AS (
  SELECT * FROM (
    SELECT t.driver_number, t.session_key, {_cum_sector()} AS sector, t.speed,
      l.duration_sector_1, l.duration_sector_2, l.duration_sector_3, t.date
    FROM telemetrys t LEFT JOIN laps l ON t.session_key = l.session_key AND t.driver_number = l.driver_number
  ) x WHERE sector IS NOT NULL
)"""

J5 = views("telemetrys", "laps") + _LABELLED + "\nSELECT * FROM lab"

R6 = views("telemetrys", "laps") + _LABELLED + "\n" + "\nUNION ALL\n".join(
    f"""SELECT 'sectors2' AS _measurement, CAST(driver_number AS VARCHAR) AS driver_number,
  CAST(session_key AS VARCHAR) AS session_key, CAST(sector AS VARCHAR) AS sector,
  '{f}' AS _field, CAST({f} AS DOUBLE) AS _value, date AS _time FROM lab WHERE {f} IS NOT NULL"""
    for f in ("speed", "duration_sector_1", "duration_sector_2", "duration_sector_3"))

_TEL_FIELDS = ("speed", "throttle", "brake", "drs")
_TEL_COMPLETE = _not_null("session_key", "driver_number", "date", "speed", "brake", "drs", "throttle")

S9 = views("telemetrys") + "\n" + "\nUNION ALL\n".join(
    f"""SELECT 'telemetry' AS _measurement, CAST(session_key AS VARCHAR) AS session_key,
  CAST(driver_number AS VARCHAR) AS driver_number, '{f}' AS _field,
  CAST(CAST(trunc({f}) AS INT) AS DOUBLE) AS _value, date AS _time
FROM telemetrys WHERE {_TEL_COMPLETE}""" for f in _TEL_FIELDS)

S1 = views("telemetrys", "sessions") + "SELECT session_key, meeting_key, session_name, circuit_short_name FROM sessions"

_FRACTION = "driver_number % 3 = 1 AND CAST(floor(speed) AS BIGINT) % 50 = 7"
S2 = views("telemetrys") + f"""
SELECT session_key, driver_number, date, drs, CASE WHEN driver_number % 3 <> 2 THEN throttle END AS throttle
FROM telemetrys WHERE NOT ({_FRACTION})"""
C15_FILES = views("telemetrys") + f"""
SELECT session_key, driver_number, date, 'bad drs' AS reason FROM telemetrys WHERE {_FRACTION}
UNION ALL SELECT NULL, NULL, NULL, 'unreadable file'"""

S10 = views("telemetrys") + "\n" + "\nUNION ALL\n".join(
    f"""SELECT 'telemetry' AS _measurement, CAST(session_key AS VARCHAR) AS session_key,
  CAST(driver_number AS VARCHAR) AS driver_number, '{f}' AS _field, CAST(CAST(trunc({f}) AS INT) AS DOUBLE) AS _value, date AS _time
FROM telemetrys WHERE session_key = {RACE} AND {_TEL_COMPLETE}""" for f in ("speed", "drs"))

A15 = views("telemetrys") + f"""
SELECT date AS _time, CAST(session_key AS VARCHAR) AS session_key, CAST(driver_number AS VARCHAR) AS driver_number,
  {", ".join(f"max(CAST(CAST(trunc({f}) AS INT) AS DOUBLE)) AS {f}" for f in _TEL_FIELDS)}
FROM telemetrys WHERE {_TEL_COMPLETE}
GROUP BY date, session_key, driver_number"""

R3B = views("tyre_stints", "weather_conditions") + f"""
, st AS (SELECT * FROM tyre_stints
         WHERE {_not_null('session_key', 'driver_number', 'stint_number', 'lap_start', 'lap_end', 'compound')}),
wc AS (SELECT * FROM weather_conditions WHERE {_not_null('session_key', 'date', 'track_temperature')})
SELECT st.compound AS compound, round({mean_exact('wc.track_temperature')}, 9) AS mean_track_temperature,
  greatest(max(CAST(st.lap_end AS DOUBLE) - CAST(st.lap_start AS DOUBLE)), 0.0) AS max_lap_duration
FROM st JOIN wc ON CAST(st.session_key AS VARCHAR) = CAST(wc.session_key AS VARCHAR)
GROUP BY st.compound
ORDER BY max_lap_duration DESC"""

_STINT_WEATHER = f"""
, st AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY session_key, stint_number, driver_number
                                 ORDER BY lap_start, lap_end) AS rn
    FROM tyre_stints
    WHERE {_not_null('session_key', 'driver_number', 'stint_number', 'lap_start', 'lap_end', 'compound')}
  ) x WHERE rn = 1
), wc AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY session_key, date ORDER BY track_temperature) AS rn
    FROM weather_conditions WHERE {_not_null('session_key', 'date', 'track_temperature')}
  ) x WHERE rn = 1 AND session_key IN (SELECT session_key FROM sessions)
), j AS (
  SELECT st.session_key, st.compound, st.driver_number, st.stint_number, st.lap_start, st.lap_end,
    wc.date, wc.track_temperature
  FROM st JOIN wc ON st.session_key = wc.session_key
)"""

R3C = views("tyre_stints", "weather_conditions", "sessions") + _STINT_WEATHER + f"""
, lww AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY session_key, compound, driver_number, date
                                 ORDER BY session_key DESC, driver_number DESC, stint_number DESC, date DESC) AS w
    FROM j) x WHERE w = 1
)
SELECT compound, round({mean_exact('track_temperature')}, 9) AS mean_track_temperature,
  greatest(max(CAST(lap_end - lap_start AS DOUBLE)), 0.0) AS max_lap_duration
FROM lww GROUP BY compound ORDER BY max_lap_duration DESC"""

A17 = views("telemetrys") + """
, pts AS (
  SELECT session_key, driver_number, date, date_trunc('second', date) AS t, f AS _field, v AS _value
  FROM telemetrys, LATERAL (VALUES ('speed', CAST(CAST(trunc(speed) AS INT) AS DOUBLE)),
                                   ('drs', CAST(CAST(trunc(drs) AS INT) AS DOUBLE))) AS u(f, v)
)
SELECT 'telemetry' AS _measurement, CAST(session_key AS VARCHAR) AS session_key,
  CAST(driver_number AS VARCHAR) AS driver_number, _field, _value, t AS _time
FROM (
  SELECT *, row_number() OVER (PARTITION BY session_key, driver_number, t, _field ORDER BY date DESC) AS w
  FROM pts) x
WHERE w = 1"""


# ----------------------------------------------------------------- timing
def _var_parts(c: str) -> tuple[str, str, str]:
    s = f"CAST(round(({c}) * 1000000) AS HUGEINT)"
    return f"CAST(count({c}) AS HUGEINT)", f"sum({s})", f"sum({s} * {s})"


_N, _SX, _SXX = _var_parts("elapsedtime")
_LOG = "(SELECT event_id AS statid, user_id AS queryid, event_type AS index_type, value AS elapsedtime FROM events)"

def _r7(where: str = "") -> str:
    """Per group the mean from sums, the quartiles from ranks, and the deviation from the sum of squares."""
    return f"""
WITH runs AS (SELECT * FROM {_LOG} entries {where})
SELECT queryid, index_type, {m2('elapsedtime')} AS mean_time,
  CAST(arg_min(elapsedtime, elapsedtime) AS DECIMAL(8,2)) AS min_time, {q2dp('elapsedtime', 0.25)} AS q1_time,
  {q2dp('elapsedtime', 0.5)} AS median_time, {q2dp('elapsedtime', 0.75)} AS q3_time,
  CAST(arg_max(elapsedtime, elapsedtime) AS DECIMAL(8,2)) AS max_time,
  CAST(CASE WHEN count(elapsedtime) > 1 THEN
    sqrt(CAST({_N} * {_SXX} - {_SX} * {_SX} AS DOUBLE) / CAST({_N} * ({_N} - 1) AS DOUBLE)) / 1e6
  END AS DECIMAL(8,2)) AS stddev_time
FROM runs GROUP BY ALL"""


R7 = _r7()
A7 = _r7("WHERE index_type = 'purchase'")

R8 = f"""
SELECT queryid, index_type, round(avg(elapsedtime), 9) AS mean, round(median(elapsedtime), 9) AS median,
  round(sqrt(CAST({_N} * {_SXX} - {_SX} * {_SX} AS DOUBLE) / CAST({_N} * {_N} AS DOUBLE)) / 1e6, 9) AS std,
  min(elapsedtime) AS min, max(elapsedtime) AS max
FROM {_LOG} runs
GROUP BY queryid, index_type"""

A18 = f"SELECT index_type, round(avg(elapsedtime), 9) AS mean_elapsedtime FROM {_LOG} runs GROUP BY index_type"


# ----------------------------------------------------------------- cleaning and the rest
C5 = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
  l_returnflag, l_linestatus, l_shipdate
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
                 l_linestatus, l_shipdate) AS rn
      FROM lineitem) x
WHERE rn = 1"""

C6 = views("drivers") + """
SELECT * FROM drivers
WHERE driver_number IS NOT NULL AND session_key IS NOT NULL AND full_name IS NOT NULL
  AND country_code IS NOT NULL AND team_name IS NOT NULL"""

C7 = "SELECT * FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer)"

C8 = views("telemetrys", "telemetrys_laps") + """
SELECT * FROM telemetrys t
WHERE EXISTS (SELECT 1 FROM telemetrys_laps tl
              WHERE tl.session_key = t.session_key AND tl.driver_number = t.driver_number)"""

C10 = """
SELECT doc_id, CASE WHEN quality IS NULL THEN TRUE ELSE quality <> 0 END AS is_quality,
  CASE WHEN toxic IS NULL THEN TRUE ELSE toxic <> 0 END AS is_toxic
FROM labels"""

C12 = "SELECT event_id, ts AS ts_utc FROM events"

C13 = """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"""

C14 = """
SELECT doc_id, lang, source FROM documents d
WHERE doc_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)"""

C15 = views("telemetrys", "laps") + """
SELECT session_key, driver_number, lap_number,
  CASE WHEN session_key IS NULL OR driver_number IS NULL OR lap_number IS NULL THEN 'null key'
       WHEN lap_duration IS NULL THEN 'null lap_duration'
       WHEN duration_sector_1 <= 0 OR duration_sector_2 <= 0 OR duration_sector_3 <= 0 THEN 'non-positive sector'
  END AS reason
FROM laps
WHERE session_key IS NULL OR driver_number IS NULL OR lap_number IS NULL OR lap_duration IS NULL
  OR duration_sector_1 <= 0 OR duration_sector_2 <= 0 OR duration_sector_3 <= 0"""

C16 = "SELECT * FROM events WHERE event_id % 20 = 0"

_PLACE = "CAST('0x' || substr(md5('42|' || event_id), 1, 15) AS BIGINT)"
C16_EXACT = f"""
SELECT * FROM events
QUALIFY row_number() OVER (ORDER BY {_PLACE}, event_id) <= (SELECT CAST(round_even(0.05 * count(*), 0) AS BIGINT) FROM events)"""

C9 = f"""
WITH many AS (SELECT event_type, count(*) AS n FROM events GROUP BY event_type),
line AS (SELECT event_type, n, coalesce(sum(n) OVER (ORDER BY event_type ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM many)
SELECT event_id, event_type,
  CAST(floor((start + floor(n * (CAST({_PLACE} AS DOUBLE) / 1152921504606846976.0))) / (SELECT ceil(count(*) / 7.0) FROM events)) AS INT) AS task_group
FROM events JOIN line USING (event_type)"""

A19 = """
WITH old AS (SELECT max(event_id) AS last FROM events WHERE event_id % 4 = 0), fresh AS (SELECT count(*) AS k FROM events WHERE event_id % 4 <> 0)
SELECT CAST(last + i AS BIGINT) AS statid, CAST(1 AS BIGINT) AS n FROM old, (SELECT unnest(range(1, k + 1)) AS i FROM fresh)"""

A10 = f"""
SELECT index_type, {", ".join(f"round(quantile_cont(elapsedtime, {p}), 9) AS q_{i}" for i, p in enumerate((0.25, 0.5, 0.75, 0.999)))}
FROM {_LOG} runs GROUP BY index_type"""

S5 = views("telemetrys", "laps", "sessions") + """
, tried AS (
  SELECT 1 AS batch, session_key, driver_number, lap_number, 1 AS copy FROM laps WHERE lap_number % 2 = 1
  UNION ALL SELECT 2, session_key, driver_number, lap_number, 1 FROM laps
  UNION ALL SELECT 3, session_key, driver_number, lap_number, unnest([1, 2]) FROM laps WHERE lap_number % 3 = 0
), told AS (
  SELECT batch, session_key, CASE WHEN copy = 2 THEN 'repeated key' WHEN race AND (batch = 3 OR batch = 2 AND lap_number % 2 = 1) THEN 'key exists'
    WHEN NOT race THEN 'no parent' END AS state
  FROM (SELECT *, session_key IN (SELECT session_key FROM sessions WHERE session_name = 'Race') AS race FROM tried)
)
SELECT coalesce(state, 'there') AS state, CASE WHEN state IS NULL THEN 0 ELSE batch END AS batch, session_key, count(*) AS n
FROM told GROUP BY ALL"""

S3 = """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k, 'landed' AS state FROM events WHERE event_id % 101 <> 0
UNION ALL SELECT NULL, NULL, 'rejected' FROM events WHERE event_id % 101 = 0
UNION ALL SELECT CAST(count(*) AS BIGINT), NULL, 'more' FROM events WHERE event_id % 101 <> 0 AND event_id % 7 = 0"""

C17 = views("telemetrys", "laps") + "SELECT DISTINCT session_key, driver_number FROM laps"

S4 = r"""
SELECT page_id,
  CASE WHEN regexp_extract(url, '/([a-z]{2})/(\d+)', 1) = '' THEN NULL
       ELSE regexp_extract(url, '/([a-z]{2})/(\d+)', 1) END AS lang,
  CASE WHEN regexp_extract(url, '/([a-z]{2})/(\d+)', 2) = '' THEN NULL
       ELSE CAST(regexp_extract(url, '/([a-z]{2})/(\d+)', 2) AS INT) END AS page_no
FROM pages"""

O4 = views("telemetrys", "laps") + """
SELECT * FROM laps ORDER BY lap_duration ASC NULLS LAST, session_key, driver_number, lap_number LIMIT 10"""

U1 = views("telemetrys", "laps", "tyre_stints") + """
SELECT session_key, driver_number, lap_number, lap_duration, NULL::INT AS stint_number, NULL::VARCHAR AS compound
FROM laps
UNION ALL
SELECT session_key, driver_number, NULL::INT, NULL::DOUBLE, stint_number, compound FROM tyre_stints"""

F11 = "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events"

W2 = views("telemetrys", "laps") + """
SELECT session_key, driver_number, lap_number, date_start, duration_sector_1, duration_sector_2,
  duration_sector_3, lap_duration
FROM (SELECT *, row_number() OVER (PARTITION BY session_key, driver_number
                                   ORDER BY lap_duration ASC NULLS LAST, lap_number) AS rn FROM laps) x
WHERE rn = 1"""

W6 = views("telemetrys") + f"""
, samples AS (
  SELECT session_key, driver_number, date, speed, CASE brake WHEN 100 THEN 'FREANDO' ELSE 'NORMAL' END AS brake_state,
    CASE WHEN drs IN (8, 10, 12, 14) THEN 'ATIVO' ELSE 'NÃO ATIVO' END AS drs
  FROM telemetrys
){_runs("drs", "brake_state")}
SELECT session_key, driver_number, nth AS run_id, drs, brake_state, opened AS start_time, closed AS end_time,
  speed_in AS start_value, speed_out AS end_value, n AS n_samples
FROM stretch"""


def operator_sql() -> dict[str, str]:
    return {
        "r3b_tyre_temp_points": R3B, "r3c_tyre_temp_denorm": R3C, "r6_sector_samples": R6, "j5_left_label": J5,
        "r7_timing_summary": R7, "a7_filtered_summary": A7, "a18_label_means": A18, "r8_timing_population": R8, "s9_points_unpivot": S9,
        "s10_points_read_back": S10, "s1_loaded_sessions": S1, "s2_differing_files": S2, "c15_rejected_rows": C15_FILES, "s2_loaded_sector_speed": R1_LOADED, "r3b_stored_points": R3B, "a15_points_pivot": A15,
        "a17_last_write_wins": A17, "c5_dedup_first": C5, "c6_drop_nulls": C6, "c7_semi_filter": C7,
        "c8_composite_semi": C8, "c10_bool_cast": C10, "c12_iso_timestamp": C12, "c13_pk_audit": C13,
        "c14_fk_audit": C14, "c15_quarantine": C15, "c16_modulus_sample": C16, "c17_distinct_pairs": C17, "c16_exact_sample": C16_EXACT, "c9_task_groups": C9, "a19_numbered_runs": A19,
        "a10_radix_quantiles": A10, "s5_appended_laps": S5, "s12_written_measure": R3C, "s3_landed_records": S3,
        "s4_path_keys": S4, "o4_topk": O4, "u1_union_by_name": U1, "f11_json_field": F11, "w2_best_lap": W2,
        "w6_islands": W6,
    }
