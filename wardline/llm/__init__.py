"""Operators of training-data pipelines: cleaning, de-duplication, counting, mixing and output.

Nothing else in the library imports this subpackage.
"""
