"""rowsmith: record reconciliation and load planning on Spark DataFrames."""
