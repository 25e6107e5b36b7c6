"""Reading, declaring, filling and versioning tables."""
