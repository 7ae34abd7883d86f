"""Readers and writers: flow files, log lines, alert files and state tables."""
