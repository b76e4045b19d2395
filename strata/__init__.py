"""strata: warehouse pipelines on PySpark."""
