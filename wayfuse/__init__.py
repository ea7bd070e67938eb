"""wayfuse: a Spark-native engine for position and radio-message analytics."""
