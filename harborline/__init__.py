"""Move, reshape and check tables with plain PySpark DataFrames."""
