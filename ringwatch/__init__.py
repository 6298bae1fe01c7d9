"""Anomaly analytics on money-transfer streams and graphs, as Spark jobs."""
