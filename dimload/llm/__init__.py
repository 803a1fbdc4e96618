"""Training-data operators on documents, pages and benchmark tables.

Nothing else in the library imports this subpackage. Each module holds one operator with its own
interface; ``queries`` holds the registered queries ``opN_<name>`` and their SQL.
"""
