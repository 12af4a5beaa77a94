"""Operators that prepare text for training language models, over tables of documents and pages.

Nothing outside this subpackage imports it.
"""
