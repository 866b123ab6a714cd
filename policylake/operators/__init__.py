"""Table operators: schema rules, quantiles, de-duplication, joins and quality checks."""
