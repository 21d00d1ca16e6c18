"""Sources and sinks: the table adapter, CSV exports, raw tables, loads."""
