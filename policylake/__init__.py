"""Insurance analytics on Spark: cleaning, star schema, claim-delay models and reports."""
