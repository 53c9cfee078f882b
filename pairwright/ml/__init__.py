"""Models on Spark MLlib: match forest and ALS recommender."""
