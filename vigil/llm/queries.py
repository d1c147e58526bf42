"""Registry of this package's queries: name -> (spark, sf_dir) -> DataFrame,
with DuckDB SQL where SQL can express the result."""

from __future__ import annotations

from vigil.llm import ann, bpe, decontam, jaccard, merkle, quality, resample, rlz, secrets, suffix, token_counts, toxicity, urls

QUERIES: dict = {}
ORACLE: dict[str, str] = {}

for module in (ann, bpe, decontam, jaccard, merkle, quality, resample, rlz, secrets, suffix, token_counts, toxicity, urls):
    QUERIES |= module.QUERIES
    ORACLE |= module.ORACLE
