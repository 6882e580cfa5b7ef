"""The two complete jobs."""
