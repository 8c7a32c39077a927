"""tablesync.sinks."""
