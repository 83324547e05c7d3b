"""Review ledger analytics on Spark."""
