"""Fine-tuning data preparation and run records as Spark DataFrames."""
