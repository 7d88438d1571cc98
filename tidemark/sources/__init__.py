"""Sources and sinks: raw landing, processed snapshot tables, report files."""
