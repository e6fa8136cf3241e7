"""Record linkage for business tables, written as PySpark DataFrame jobs."""
