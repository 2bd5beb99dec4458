"""Collar telemetry analytics as Spark jobs: ingest, cleaning, models, checks, dashboards."""
