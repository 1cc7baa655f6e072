"""Receipt text and model responses to a clean 30-column line-item table, on Spark."""
