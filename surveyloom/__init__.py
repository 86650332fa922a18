"""Survey analytics on Spark: strict ingest, conformed rows, segment aggregates, KPI queries."""
