"""tablesync.streaming."""
