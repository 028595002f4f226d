"""All queries of the subpackage; importing this registers them."""

from . import (  # noqa: F401
    align, bpe, chunks, collocations, decontam, lines, lm, perplexity, rules, secrets, setjoin, shards, warc,
)
from .registry import QUERIES, SQL  # noqa: F401
