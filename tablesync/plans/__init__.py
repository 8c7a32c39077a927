"""tablesync.plans."""
