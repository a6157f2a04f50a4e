"""DataFrame operators: enrichment, location, product, quality, duplicates, marts."""
