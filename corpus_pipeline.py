"""From raw documents to token ids: five stages over the documents table.

Each stage is a function (spark, docs, sf_dir) -> DataFrame over all that its
predecessor kept; its result is written as Parquet in the shared folder and
read again as the next one's docs.  All but the last return the columns of
documents:

1. language ID drops documents without a language;
2. MinHash near-dedup keeps the document of the least id of each class;
3. substring dedup cuts passages that start earlier elsewhere from the texts;
4. mixing takes documents by source weights, some of them twice;
5. SentencePiece encodes what is left: counts and digests of ids and texts.

Null or empty texts go in stage 1; an empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridstream.llm import language_id, mixing, near_dedup, sentencepiece_bpe, substring_dedup
from gridstream.llm.common import table, written

STAGES = [
    ("language_id", language_id.stage),
    ("near_dedup", near_dedup.stage),
    ("substring_dedup", substring_dedup.stage),
    ("mixing", mixing.stage),
    ("sentencepiece", sentencepiece_bpe.stage),
]

#: No SQL: kernel models, signatures and SentencePiece merges are outside SQL.
#: The tests hold every stage and the whole run against brute force or the
#: library instead (tests/llm/test_pipeline.py).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
