"""Sales-warehouse cleaning, enrichment and graph projection as Spark DataFrame plans."""
