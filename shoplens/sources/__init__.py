"""Readers: source files, landed partitions, API payloads, fixture views."""
