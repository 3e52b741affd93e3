"""Training-data operators: one module per operator, queries in ``registry``.

Nothing else in the package imports this subpackage.
"""
