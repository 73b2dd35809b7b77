"""Spark-native incremental loading, form flattening, linked data and cohort queries for lab metadata."""
