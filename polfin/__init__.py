"""Political-finance and legislative data on Spark."""
