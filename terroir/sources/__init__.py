"""Readers and writers: files, JDBC and event topics."""
