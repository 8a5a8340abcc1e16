"""paddock: session telemetry analytics on Spark.

Typical use::

    from paddock import get_spark, standin_tables, reports
    spark = get_spark()
    t = standin_tables(spark, "/path/to/parquet/tables")      # or load_reference_layout / tables_from_catalog
    reports.temperature_speed(t, session_key=9992).show()
"""

from paddock.plans import point_reports, reports, timing
from paddock.session import checkpoint_dir, get_spark
from paddock.sources.load import load_reference_layout, write_tables
from paddock.sources.standin import standin_tables
from paddock.sources.tables import Tables

__version__ = "0.1.0"

__all__ = ["Tables", "checkpoint_dir", "get_spark", "load_reference_layout", "point_reports", "reports",
           "standin_tables", "timing", "write_tables"]
