"""Sources and sinks: typed scans, literal tables, payload flattening, resumable appends."""
