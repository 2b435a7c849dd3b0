"""What the driver's contract adds for this subpackage."""

from __future__ import annotations

import corpus_pipeline
from tickmacro.llm import oracles, queries

LLM_QUERIES = {**queries.LLM_QUERIES, "pipeline": corpus_pipeline.run}
LLM_ORACLES = dict(oracles.LLM_ORACLES)
if corpus_pipeline.ORACLE_SQL is not None:
    LLM_ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
