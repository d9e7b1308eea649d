"""Operators of a training-data pipeline: one module per operator.

Nothing else in the library imports this subpackage.  ``queries`` holds the
registered queries, ``oracles`` their SQL; the other modules are operators and
the helpers they share (``common``: Spark side, ``bytesops``: numpy on text
bytes, ``repeats``: which window hashes occur more than once).
"""
