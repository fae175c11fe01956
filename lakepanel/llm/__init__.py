"""Operators of a large-scale training-data pipeline.

Nothing else in the library imports this subpackage.  Each module holds one
operator with its own general interface; ``queries`` derives the registered
``opN_*`` results from them.
"""
