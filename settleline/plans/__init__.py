"""Plans: the batch pipeline and the registered query catalogue."""
