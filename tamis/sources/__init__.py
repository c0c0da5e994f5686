"""Readers, lake writes, snapshots and logs on any file system Spark can reach."""
