"""Readers: files, bad-record capture, incremental loads, tables, JDBC."""
