"""User-profile metrics for a travel membership app, computed with Spark DataFrames."""
