"""riskloom.functions."""
