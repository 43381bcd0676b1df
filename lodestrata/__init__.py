"""lodestrata: a PySpark-native engine for cross-source evidence corpora."""
