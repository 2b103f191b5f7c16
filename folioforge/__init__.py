"""Portfolio risk and return analytics on PySpark."""
