"""Readers (tables, dated snapshots, files) and writers (snapshots, upserts, exports)."""
