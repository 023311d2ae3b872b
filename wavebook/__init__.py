"""Survey analytics on Spark: definitions, waves, cleaning, checks and reports."""
