"""Sources and sinks: raw scans, driver-table mapping, lookups, exports."""
