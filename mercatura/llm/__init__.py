"""Operators for preparing training data: quality, tokens, packing, filtering, deduplication, search.

Nothing outside this subpackage imports it; it imports only general helpers of the library.
"""
