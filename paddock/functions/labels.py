"""Sector and state labels.

The reference uses four different sector conventions that look alike; each is a
``mode`` here and each is a plain chained ``when`` (no UDF). ``sector_reach``
gives, per mode, the time span outside which no sample can get a non-null
label, so an interval join can restrict samples to laps before labelling.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from paddock.functions.timefn import plus_seconds, seconds, seconds_between

# Fixed values that must equal the reference's output labels.
SECTOR_NAMES = ("SECTOR 1", "SECTOR 2", "SECTOR 3")
SETOR_NAMES = ("SETOR 1", "SETOR 2", "SETOR 3")
BRAKE_ON, BRAKE_OFF = "FREANDO", "NORMAL"
DRS_ON, DRS_OFF = "ATIVO", "NÃO ATIVO"
DRS_OPEN_CODES = (8, 10, 12, 14)
BRAKE_FULL = 100

MODES = ("strict", "offset", "halfopen", "cumulative")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sector_label(ts, start, d1, d2, d3, mode: str, names=None) -> Column:
    """Label a sample time against one lap.

    * ``strict`` (report 1): open intervals on cumulative ends, the last one closed
      on the right: ``start<t<e1``, ``e1<t<e2``, ``e2<t<=e3`` with
      ``e_k = start + (d1+..+dk)``. Samples exactly on start, e1, e2 get null.
    * ``offset`` (report 2): non-cumulative ends with a one-second gap:
      ``[start, start+d1]``, ``[start+1s+d1, start+d2]``, ``[start+1s+d2, start+d3]``.
    * ``halfopen`` (report 4): non-cumulative ends, ``[start, start+d1]``,
      ``(start+d1, start+d2]``, ``(start+d2, start+d3]``.
    * ``cumulative`` (points variant of report 1): ``[start, e1]``, ``(e1, e2]``,
      ``(e2, e3]`` with ``e1 = start+d1``, ``e2 = e1+d2``, ``e3 = e2+d3``; the labels
      are the integers 1, 2, 3.

    The first matching arm wins, as in SQL ``CASE``; anything else is null.
    """
    t, s = _c(ts), _c(start)
    d1, d2, d3 = _c(d1), _c(d2), _c(d3)
    if mode == "strict":
        n = names or SECTOR_NAMES
        e1 = plus_seconds(s, d1)
        e2 = plus_seconds(s, d1 + d2)
        e3 = plus_seconds(s, d1 + d2 + d3)
        return (F.when((t > s) & (t < e1), n[0])
                .when((t > e1) & (t < e2), n[1])
                .when((t > e2) & (t <= e3), n[2]))
    if mode == "offset":
        n = names or SECTOR_NAMES
        one = seconds(F.lit(1))
        return (F.when((t >= s) & (t <= plus_seconds(s, d1)), n[0])
                .when((t >= s + one + seconds(d1)) & (t <= plus_seconds(s, d2)), n[1])
                .when((t >= s + one + seconds(d2)) & (t <= plus_seconds(s, d3)), n[2]))
    if mode == "halfopen":
        n = names or SETOR_NAMES
        e1, e2, e3 = plus_seconds(s, d1), plus_seconds(s, d2), plus_seconds(s, d3)
        return (F.when((t >= s) & (t <= e1), n[0])
                .when((t > e1) & (t <= e2), n[1])
                .when((t > e2) & (t <= e3), n[2]))
    if mode == "cumulative":
        n = names or (1, 2, 3)
        e1 = plus_seconds(s, d1)
        e2 = e1 + seconds(d2)
        e3 = e2 + seconds(d3)
        return (F.when((t >= s) & (t <= e1), F.lit(n[0]))
                .when((t > e1) & (t <= e2), F.lit(n[1]))
                .when((t > e2) & (t <= e3), F.lit(n[2])))
    raise ValueError(f"unknown sector mode {mode!r}; expected one of {MODES}")


def sector_reach(start, d1, d2, d3, mode: str) -> tuple[Column, Column]:
    """``(lo, hi)`` such that every non-null label of ``mode`` lies in ``[lo, hi]``.

    ``strict`` returns the reference's own join window
    ``[start, start + (d1+d2+d3)]``. For the non-cumulative modes the end is the
    latest sector end that is not null (``greatest`` skips nulls).
    """
    s = _c(start)
    d1, d2, d3 = _c(d1), _c(d2), _c(d3)
    if mode == "strict":
        return s, plus_seconds(s, d1 + d2 + d3)
    if mode == "cumulative":
        return s, plus_seconds(s, d1) + seconds(d2) + seconds(d3)
    if mode in ("offset", "halfopen"):
        return s, F.greatest(plus_seconds(s, d1), plus_seconds(s, d2), plus_seconds(s, d3))
    raise ValueError(f"unknown sector mode {mode!r}")


def brake_state(brake) -> Column:
    """``FREANDO`` when the brake is fully applied, else ``NORMAL``."""
    return F.when(_c(brake) == BRAKE_FULL, BRAKE_ON).otherwise(BRAKE_OFF)


def drs_state(drs) -> Column:
    """``ATIVO`` when the DRS code says open, else ``NÃO ATIVO``."""
    return F.when(_c(drs).isin(*DRS_OPEN_CODES), DRS_ON).otherwise(DRS_OFF)


def instant_acceleration(speed, prev_speed, date, prev_date) -> Column:
    """``((v - v_prev) / 3.6) / dt`` in m/s^2; 0 when ``dt = 0``; null on the first sample.

    The guard sits inside ``when`` so ANSI division never sees a zero.
    """
    dt = seconds_between(_c(prev_date), _c(date))
    return (F.when(dt > 0, ((_c(speed) - _c(prev_speed)) / F.lit(3.6)) / dt)
            .when(dt == 0, F.lit(0.0)))
