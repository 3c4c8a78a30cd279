"""A PySpark-native engine for curating large collections of generated text records."""
