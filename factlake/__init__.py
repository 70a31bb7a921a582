"""factlake: evidence-linked event analytics on Spark DataFrames."""
