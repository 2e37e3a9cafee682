"""Operators for preparing training text at scale, with their queries.

Each module holds one operator, the query that runs it over the given tables and, where SQL can
say it, the SQL. Nothing else in the library imports this subpackage.
"""

from litquarry.llm.registry import oracles, queries  # noqa: F401
from litquarry.llm import (  # noqa: F401
    decontamination, exact_dedup, language, line_dedup, packing, prefix_trie, quality_classifier, quality_rules, secrets, sentencepieces, sharding, simhash, vector_codes,
)
