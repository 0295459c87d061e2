"""Readers and writers for the log, file and framed-record formats."""
