"""Readers and writers of the tables in `voxlake.schema`."""
