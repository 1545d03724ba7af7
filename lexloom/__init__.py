"""A PySpark-native engine for curating and evaluating large record collections."""
