"""PySpark-native analytics for wide, labelled measurement tables."""
