"""Legal-corpus data engine on Spark: DataFrame in, DataFrame out."""
