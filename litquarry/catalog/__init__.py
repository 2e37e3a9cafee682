"""Every operator run over the given tables, with the same question in SQL.

Each module registers functions of (spark, folder of tables) that return a
DataFrame, and beside each the SQL text that answers it on the same tables.
"""

from litquarry.catalog.registry import oracles, queries  # noqa: F401
from litquarry.catalog import chats, evidence, files, ontologies, samples, texts  # noqa: F401
