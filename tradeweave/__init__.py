"""Securities settlement linking, fee and reporting analytics on PySpark."""
