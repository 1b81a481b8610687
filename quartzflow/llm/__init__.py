"""Operators for training data: label consensus, packing, leaked test items, personal information.

Nothing outside this package imports it.
"""
