"""Readers and writers of site tables, genotypes, maps, chunk files and reports."""
