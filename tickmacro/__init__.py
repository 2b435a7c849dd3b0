"""Market bars and macro series on Spark: DataFrame in, DataFrame out."""
