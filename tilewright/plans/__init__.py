"""From requests to jobs and tiles."""
