"""A PySpark-native analytics engine for archives of scanned documents."""
