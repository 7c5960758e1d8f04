"""Readers and writers of the files that travel between sites, and of stored tables."""
