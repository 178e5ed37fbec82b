"""Order analytics as Spark jobs: ingest, quality rules, marts, reports, streams."""
