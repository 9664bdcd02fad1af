"""Operators for building language-model training data.

Nothing else in the library imports this subpackage. Spark partitions, shuffles
and joins the rows; numpy and Arrow work on one batch inside a task.
"""
