"""A PySpark-native engine for the data work around supervised fine-tuning."""
