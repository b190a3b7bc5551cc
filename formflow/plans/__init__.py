"""Composed queries: the report and operational views, the batch jobs, the query catalog."""
