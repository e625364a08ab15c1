"""Long-document processing on Spark: DataFrame in, DataFrame out."""
