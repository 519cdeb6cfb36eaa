"""Facts, publishing, and the query catalogue."""
