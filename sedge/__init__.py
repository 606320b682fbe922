"""sedge: a PySpark-native engine that turns document collections into queryable tables."""
