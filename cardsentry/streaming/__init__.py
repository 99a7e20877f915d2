"""The daily cycle as an incremental file stream (AvailableNow + foreachBatch)."""
