"""canonflow: a rulebook-driven canonicalisation engine on Spark DataFrames."""
