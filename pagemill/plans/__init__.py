"""Complete plans: the ingestion run, the registered queries and their SQL twins."""
