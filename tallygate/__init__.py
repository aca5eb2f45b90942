"""Transaction data quality on Spark: land, gate, quarantine, measure, check."""
