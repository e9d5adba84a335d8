"""Model stages on Spark MLlib: splits, the estimator registry, training,
evaluation, clustering and persistence."""
