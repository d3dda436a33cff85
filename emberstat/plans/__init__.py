"""Registered queries: stand-in inputs built from the test tables (``standins``),
their DuckDB twins (``sqlparts``) and one module of queries per group
(``q_prep``, ``q_charts``, ``q_text``, ``q_topics``, ``q_models``)."""
