"""bankops: DataFrame operators for banking data on Spark."""
