"""Operators of a training-data pipeline.

Nothing else in the library imports this subpackage; it may import the
library's general helpers (session, table reader).  Tables may have any
further columns, but names that begin with two underscores are the operators'.
"""
