"""riskloom.operators."""
