"""Listing-crawl analytics as DataFrame and Structured Streaming jobs."""
