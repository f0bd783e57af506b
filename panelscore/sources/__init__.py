"""Readers, control file and month-partitioned sinks."""
