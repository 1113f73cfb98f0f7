"""Trending-term analytics over a text corpus, written as Spark DataFrame jobs."""
