"""Training-data operators for large text corpora (one module per operator).

Nothing else in the library imports this subpackage. ``queries`` holds the
registered queries over the driver's tables and, where SQL can say it, their SQL.
"""
