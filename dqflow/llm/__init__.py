"""Training-data operators.  Nothing outside this folder imports it.

Each module holds one operator with its own interface; ``queries`` registers the
thin ``opN_<name>`` queries over the driver's tables.
"""
