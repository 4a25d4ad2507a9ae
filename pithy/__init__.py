"""Summarise article-summary corpora and score the summaries, as Spark jobs."""
