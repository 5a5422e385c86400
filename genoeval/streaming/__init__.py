"""Incremental evaluation of chromosomes as they arrive."""
