"""Data quality and master-data cleansing as Spark DataFrame plans."""
