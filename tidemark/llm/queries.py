"""All queries of this package, with their SQL where SQL can say it."""

from tidemark.llm import bpe, chat_format, codes, jaccard, licenses, lm, merkle, packing, quality, resampling, topk, toxicity, warc  # noqa: F401
from tidemark.llm.common import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
