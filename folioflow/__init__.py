"""folioflow: Spark-native document ingestion, from decoded pages to citation-carrying chunks."""
