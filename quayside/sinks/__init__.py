"""Writing DataFrames to tables, documents, items, messages and files outside Spark."""
