"""Operators for preparing large language-model training corpora.

Each module holds one operator with a general interface; `queries` derives the
registered result columns from them. Nothing else in the library imports this
subpackage.
"""
