"""foliowright: page-corpus cleaning and restructuring on Spark DataFrames."""
