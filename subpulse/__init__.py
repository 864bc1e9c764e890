"""Subscription analytics on Spark: staging, metrics, health, quality, drift, lateness."""
