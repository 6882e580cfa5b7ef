"""Documents derived from flat tables."""
