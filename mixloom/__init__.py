"""mixloom: marketing analytics on Spark DataFrames.

Revenue preparation, customer scoring, lifetime value, churn models and
marketing-mix analysis, each written as DataFrame transformations.
"""
