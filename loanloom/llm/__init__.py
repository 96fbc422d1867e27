"""Training-data operators: each module is one operator, usable on its own.

Nothing outside this subpackage imports it; ``queries`` holds the registered queries.
"""
