"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage; it uses the shared-folder
helpers of the library and is registered by ``__spark_entry__`` if present.
"""
