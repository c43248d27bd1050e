"""riskloom.streaming."""
