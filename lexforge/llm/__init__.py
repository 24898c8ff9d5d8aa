"""Operators for large training-data pipelines: DataFrame in, DataFrame out.

Nothing else in the package imports this subpackage.
"""
