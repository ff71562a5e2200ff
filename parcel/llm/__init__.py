"""Operators for preparing training data.

One module per operator; ``queries.py`` holds the driver queries and their SQL.
Nothing else in the library imports this subpackage.
"""
