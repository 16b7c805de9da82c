"""Operators over document tables for preparing training text.

Every operator picks the columns it names from its input, so further columns never matter, and
returns its own. An empty table gives an empty result with the same columns.
"""
