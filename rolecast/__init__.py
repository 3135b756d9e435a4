"""rolecast: persona enrichment of contact tables on PySpark."""
