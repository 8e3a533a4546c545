"""A Spark-native engine that turns specification documents into a queryable, release-versioned parts catalog."""
