"""Operators for preparing language-model training data, each a Spark job over whole tables.

Nothing else in the library imports this subpackage; ``__spark_entry__`` adds
its queries when it is present.
"""
