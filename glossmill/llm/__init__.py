"""Training-data operators: ten stand-alone corpus operators and their queries.

Nothing else in the library imports this subpackage.
"""
