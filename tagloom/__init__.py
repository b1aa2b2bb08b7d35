"""tagloom: a mapping-driven feature engine on Spark DataFrames."""
