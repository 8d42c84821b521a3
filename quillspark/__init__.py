"""Spark-native normalisation, structuring and search of administrative documents."""
