"""Jobs made of operators and tier tables: ingest, roll-up, backfill, dashboard."""
