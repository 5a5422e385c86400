"""Spark-native table operators for preparing and scoring imputed genotypes."""
