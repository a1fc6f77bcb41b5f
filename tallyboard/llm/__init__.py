"""Operators that prepare text corpora for model training.

Nothing else in the package imports this folder. Every operator takes and
returns DataFrames; Python runs only inside tasks, on Arrow batches.
"""
