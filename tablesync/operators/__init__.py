"""tablesync.operators."""
