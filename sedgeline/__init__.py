"""Spark-native engine for schema documents (RDF, digital-twin interfaces, business-data manifests)."""
