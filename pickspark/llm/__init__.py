"""Training-data operators over tables of documents and pages.

Nothing else in the library imports this subpackage.
"""
