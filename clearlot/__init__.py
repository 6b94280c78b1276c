"""Supply-chain data quality on Spark: clean, tag, check references, curate, report, synthesise."""
