"""Ledger analytics on Spark: streaming ingestion, reports, models and checks
for blocks, transactions and event logs."""
