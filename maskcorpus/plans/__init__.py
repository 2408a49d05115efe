"""Plans: derived input views, the registered query set and the staged pipeline."""
