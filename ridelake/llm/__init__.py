"""Operators for preparing large text corpora (training data) on Spark.

Nothing else in the package imports this subpackage; ``queries.py`` registers
its operators and ``__spark_entry__.py`` adds them when it can be imported.
"""
