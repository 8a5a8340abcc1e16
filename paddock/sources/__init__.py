"""Sources and sinks: typed reads, the table load, the stand-in tables, catalog writes."""
