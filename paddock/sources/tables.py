"""A bundle of the telemetry tables a report reads.

Reports take a ``Tables`` and never read files themselves, so the same report
runs on the loaded warehouse tables (``load_reference_layout``), on the stand-in views
derived from the driver's synthetic tables (``standin_tables``) or on hand-made
rows in tests.
"""

from __future__ import annotations

from dataclasses import dataclass, fields, replace

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Tables:
    telemetrys: DataFrame | None = None
    sessions: DataFrame | None = None
    telemetrys_laps: DataFrame | None = None
    laps: DataFrame | None = None
    drivers: DataFrame | None = None
    weather_conditions: DataFrame | None = None
    tyre_stints: DataFrame | None = None
    meetings: DataFrame | None = None
    pits: DataFrame | None = None
    positions: DataFrame | None = None
    race_controls: DataFrame | None = None

    def with_(self, **frames: DataFrame) -> "Tables":
        return replace(self, **frames)

    def time_ranges(self):
        """The ``TimeRanges`` of the ordered operators over telemetry, None where no driver's rows need cutting; worked out once."""
        if "_time_ranges" not in self.__dict__:
            from paddock.operators.ranges import quantile_ranges
            object.__setattr__(self, "_time_ranges", quantile_ranges(self.telemetrys, ["session_key", "driver_number"], "date"))
        return self.__dict__["_time_ranges"]

    def names(self) -> list[str]:
        return [f.name for f in fields(self) if getattr(self, f.name) is not None]

    def register(self, prefix: str = "") -> None:
        """Register every present table as a temp view (for ``spark.sql`` reports, S7)."""
        for n in self.names():
            getattr(self, n).createOrReplaceTempView(prefix + n)
