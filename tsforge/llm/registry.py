"""What the driver's entry module adds to its queries."""

from __future__ import annotations

import corpus_pipeline

from tsforge.llm import queries

QUERIES = {**queries.QUERIES, "pipeline": corpus_pipeline.run}
ORACLE_SQL = dict(queries.ORACLE_SQL)
if corpus_pipeline.ORACLE_SQL:
    ORACLE_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
