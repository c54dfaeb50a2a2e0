"""Spark-native topology inference from meter voltage series, and corpus operators in ``llm``."""
