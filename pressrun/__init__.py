"""PySpark-native engine for multi-source news records."""
