"""The registered queries and, for each that SQL can express, the SQL it must agree with."""

from catalog import corpus_queries, evaluation_queries, model_queries, text_queries

ENTRIES = [
    *corpus_queries.ENTRIES,
    *text_queries.ENTRIES,
    *evaluation_queries.ENTRIES,
    *model_queries.ENTRIES,
]
