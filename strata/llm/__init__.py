"""Operators for preparing large training corpora.

One module per operator, shared helpers in ``common``, ``components`` and
``tokens``. Nothing else in the library imports this subpackage.
"""
