"""Subscription-lifecycle and ad-spend analytics as Spark DataFrame jobs."""
