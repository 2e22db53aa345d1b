"""millrace: a PySpark-native engine that refines instruction-tuning data."""
