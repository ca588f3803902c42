"""Structured Streaming versions of batch scoring and drift monitoring."""
