"""DataFrame transforms: quality checks, splits, summarisers, scores, reports."""
