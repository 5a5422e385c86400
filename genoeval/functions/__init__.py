"""Column expressions over genotypes, alleles and chromosome names."""
