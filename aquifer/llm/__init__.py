"""Training-data operators: ten distributed text operators and their queries.

Nothing outside this package imports it.  Every operator takes a DataFrame and
returns a DataFrame; the thin ``opN_*`` queries live in :mod:`aquifer.llm.queries`.
"""
