"""Relational event data to language-model training data, on Spark."""
