"""atrium: people-flow and venue analytics on Spark DataFrames."""
