"""Operators of a training-data pipeline over documents, pages and benchmark items.

Every operator names its id and text columns as parameters, works on whole
texts and treats a null text as an empty one. Nothing else in the library
imports this package.
"""
