"""tablesync.sources."""
