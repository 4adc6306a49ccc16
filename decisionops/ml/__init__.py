"""Model dataflow on Spark ML: in-fold preprocessing, candidate families,
cross-validated benchmark, out-of-fold scores, random search, holdout
evaluation and persistence."""
