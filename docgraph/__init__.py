"""docgraph: API-documentation pages as an evidence-carrying graph, in PySpark."""
