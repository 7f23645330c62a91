"""Stage extraction and data-mart loading on Spark."""
