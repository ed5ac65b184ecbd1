"""Price-panel analytics as Spark jobs: staging, daily base, monthly panel, folds, models, forecasts."""
