"""DataFrame operators over sites and genotype arrays."""
