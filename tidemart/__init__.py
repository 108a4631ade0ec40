"""A Spark-native real-time warehouse for a shop's change log and page log."""
