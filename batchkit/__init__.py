"""batchkit: dated batch analytics on order, score and retail tables, built on Spark DataFrames."""
