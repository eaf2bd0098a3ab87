from panelspark.plans.queries_ml import training_frames  # noqa: F401
