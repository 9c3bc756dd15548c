"""Reading raw files, writing layers, and the catalog assertions."""
