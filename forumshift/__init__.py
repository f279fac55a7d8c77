"""forumshift: a Spark-native migration of forum-board data between two portal schemas.

Layout
------
``sources``    read source/target tables (parquet, JDBC) and build them from the driver tables
``functions``  column expressions: time shifts, flag words, text, casts
``operators``  reusable relational write operators: insert-only merge, update-only merge,
               update from aggregate, surrogate keys, lineage, scalar lookups, EAV pivot,
               board-scoped product joins, publish
``plans``      one function per migration flow, composed by :class:`plans.migration.Migration`
"""

__version__ = "0.1.0"
