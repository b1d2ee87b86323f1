"""Operators for preparing training text, as ``DataFrame -> DataFrame`` functions.

Nothing else in the library imports this subpackage. Each module holds one operator
with its own interface; ``catalog`` holds the thin registered queries over the
``documents``, ``pages`` and ``benchmark`` tables, ``catalog_sql`` their SQL.

Common rules of all operators: a NULL text is an empty text, NULL ids are kept and
compared as equal to each other, rows with the same id and the same text are one
document that stands in several rows (each of them gets the same result), only the
id and text columns are read (extra columns of any name do no harm), and an empty
table gives an empty result of the same schema.
"""
