"""Text-classification studies as Spark jobs.

Corpora, features, predictions and reports are DataFrames; the small
vectorizer x classifier grid is a driver loop that submits Spark jobs.
"""
