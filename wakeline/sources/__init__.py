"""Sources and sinks: driver tables, raw ping files, prediction logs, tables we write."""
