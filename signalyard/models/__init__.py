"""Walk-forward regression over 5-day intervals (ML2-ML6) on Spark ML."""
