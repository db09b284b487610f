"""Readers and writers: record snapshots, file listings, id lists, refresh decisions."""
