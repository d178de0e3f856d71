"""Feature pipelines, models, scoring and hyper-parameter search on Spark ML."""
