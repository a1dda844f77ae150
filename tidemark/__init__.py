"""tidemark: a PySpark-native analytics engine for news articles and the deals they report."""
