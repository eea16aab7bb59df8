"""Threat-observation analytics on PySpark: canonical values, folds, stores, streams and corpus preparation."""
