"""Sources and sinks: CSV ingest (S1-S5), tables and layers (S6-S9), and
the RAW mapping over the driver's tables used as test input."""
