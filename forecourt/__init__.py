"""Sales-warehouse operators for Spark: DataFrame in, DataFrame out."""
