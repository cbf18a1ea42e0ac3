"""spanguard: a PySpark-native engine for text safety and text-data preparation."""
