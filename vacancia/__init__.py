"""Job-market analytics on Spark: DataFrame jobs from archived pages to marts."""
