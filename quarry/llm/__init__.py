"""Training-data pipeline operators.

Ten operators over a table of documents, one module each; ``queries`` holds
the registered queries.  Nothing else in the library imports this package.
"""
