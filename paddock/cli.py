"""Run one report and show it: ``python -m paddock.cli <report> [options]``.

Reads the tables from a catalog database (``--schema``) or builds the stand-in
tables from a directory of the driver's parquet files (``--standin``). Prints
the row count, the seconds taken and the first rows; ``--csv`` also writes the
whole result as CSV.
"""

from __future__ import annotations

import argparse
import time

from paddock import api
from paddock.plans import reports as R
from paddock.sources.files import write_csv
from paddock.sources.standin import RACE_SESSION, standin_tables

STANDIN = {
    "drivers": lambda t: R.all_drivers(t),
    "first": lambda t: R.sector_speed(t),
    "second": lambda t: R.sector_acceleration(t, RACE_SESSION),
    "third": lambda t: R.tyre_temperature(t),
    "fourth": lambda t: R.drs_runs(t),
    "fifth": lambda t: R.temperature_speed(t, RACE_SESSION),
}


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__)
    ap.add_argument("report", choices=sorted(api.COMMANDS))
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--schema", help="catalog database holding the eleven tables")
    src.add_argument("--standin", help="directory with the driver's parquet tables")
    ap.add_argument("--csv", help="write the result here as CSV")
    ap.add_argument("--show", type=int, default=20)
    a = ap.parse_args(argv)

    from paddock.session import get_spark
    spark = get_spark("paddock-cli")
    t0 = time.perf_counter()
    if a.schema:
        df = api.COMMANDS[a.report](spark, a.schema)
    else:
        df = STANDIN[a.report](standin_tables(spark, a.standin))
    if a.csv:
        write_csv(df, a.csv)
    n = df.count()
    print(f"rows: {n}  columns: {len(df.columns)}  seconds: {time.perf_counter() - t0:.2f}")
    df.show(a.show, truncate=False)


if __name__ == "__main__":
    main()
