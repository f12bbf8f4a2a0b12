"""Plans: Bronze, Silver, Gold, audit, the DAG that runs them, and the reports on top."""
