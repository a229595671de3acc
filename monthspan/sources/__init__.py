"""Reading and writing: dictionary, raw files, stage tables."""
