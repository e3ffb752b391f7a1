"""Column operators: preparation, linking, enrichment, fees, measures."""
