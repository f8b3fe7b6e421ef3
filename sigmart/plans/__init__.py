"""Multi-operator jobs: ingestion run, warehouse build, and the views over the supplied tables."""
