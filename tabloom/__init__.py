"""Spark-native operators for tabular binary-classification pipelines."""
