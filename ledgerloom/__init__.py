"""General-ledger analytics as Spark DataFrame operators and batch jobs."""
