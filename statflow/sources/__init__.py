"""Readers: streams, database tables, seed files, landing zones and key lists."""
