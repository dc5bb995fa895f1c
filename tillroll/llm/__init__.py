"""Operators of a training-data pipeline.

Every module holds one operator with a general interface (a DataFrame and
column names in, a DataFrame out); ``queries`` applies them to the test
tables.  Nothing else in the library imports this subpackage.
"""
