"""A Spark-native engine for ingesting, reconciling and analysing catalogue data, and for preparing training corpora."""
