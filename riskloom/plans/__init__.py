"""riskloom.plans."""
