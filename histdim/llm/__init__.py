"""Operators for large-scale training-data preparation.

Ten operators over the tables ``documents``, ``pages``, ``benchmark`` and
``labels``; ``registry`` holds their queries and SQL oracles.  Nothing outside
this package imports it.
"""
