"""A PySpark-native engine for immune-repertoire long reads and the tables made from them."""
