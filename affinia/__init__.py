"""Spark-native analytics: graph recommendation, basket mining, clustering,
item-item collaborative filtering and cross-validated classifier studies."""
