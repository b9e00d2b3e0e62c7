"""Operators of a training-data pipeline over text, pages and embeddings.

Nothing else in the library imports this subpackage. ``queries`` registers one
query per operator; the operators have general interfaces of their own.
"""
