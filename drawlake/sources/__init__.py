"""Sources and sinks: CSV/JSON files, JDBC tables, HTML page sets."""
