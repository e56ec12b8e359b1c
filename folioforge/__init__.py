"""folioforge: a Spark-native engine for structured, versioned document corpora."""
