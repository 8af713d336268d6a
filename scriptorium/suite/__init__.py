"""The queries of ``__spark_entry__``, each with the SQL that checks it where there is one.

The modules group them by topic. ``QUERIES`` maps a name to ``(spark, folder) -> DataFrame``;
``SQL`` maps a name to the equivalent DuckDB statement.
"""

from scriptorium.suite import catalogues, files, markup, sets, texts, vectors

MODULES = (texts, catalogues, markup, sets, vectors, files)


def all_queries():
    return {name: q for m in MODULES for name, q in m.QUERIES.items()}


def all_sql():
    return {name: s for m in MODULES for name, s in m.SQL.items()}
