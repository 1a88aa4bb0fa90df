"""Operators for preparing training data at scale.

Nothing outside this subpackage imports it.  Each module holds one operator with
a general interface; :mod:`namewright.llm.queries` applies them to the test tables.
"""
