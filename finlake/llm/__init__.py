"""Operators of a training-data pipeline (de-duplication, counts, packing, filters).

Nothing else in the library imports this package. ``queries`` registers one
query per operator; each ``opN`` module holds one operator with its general
interface.
"""
