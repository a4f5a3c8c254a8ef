"""millrace: a Spark-native engine for preparing, scoring and auditing training data."""
