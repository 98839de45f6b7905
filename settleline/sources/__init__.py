"""Sources: readers that produce the landing DataFrame."""
