"""A PySpark-native engine for analytics over collections of structured documents."""
