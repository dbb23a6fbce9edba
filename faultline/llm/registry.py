"""What the entry module adds: the queries of this folder with the pipeline, and their SQL."""

from __future__ import annotations

import corpus_pipeline
from faultline.llm.oracles import ORACLES as _ORACLES
from faultline.llm.queries import QUERIES as _QUERIES

QUERIES = {**_QUERIES, "pipeline": corpus_pipeline.run}
ORACLES = dict(_ORACLES)
