"""Text-corpus engine on Spark: load, filter, deduplicate, mine, format, mix and evaluate corpora as DataFrames."""
