"""Spark jobs over hourly observation series: ingest, dedup, marts, checks, features, forecasts."""
