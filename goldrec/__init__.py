"""Entity consolidation on Spark: candidates, golden records, enrichment, export."""
