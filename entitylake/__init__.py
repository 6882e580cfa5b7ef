"""Analytics over nested master-data documents, as DataFrame functions."""
