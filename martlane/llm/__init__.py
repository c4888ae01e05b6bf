"""Training-data operators over documents, conversations and embeddings.

Self-contained: nothing outside this subpackage imports it.  ``queries.py``
holds the registered queries; every other module is one operator.
"""
