"""riskloom.sources."""
