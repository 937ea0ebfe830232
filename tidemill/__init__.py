"""tidemill: batch statistics, streaming counts and recommendations on PySpark."""
