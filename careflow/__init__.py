"""careflow: normalising clinical visit data with Spark DataFrames."""
