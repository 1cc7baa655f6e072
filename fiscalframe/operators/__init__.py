"""Row-local and aggregate operators over receipt tables."""
