"""Byte-balanced shards of indivisible groups by Karmarkar-Karp differencing."""

from __future__ import annotations

import heapq
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from litquarry.llm.common import documents, text_or_empty
from litquarry.llm.registry import query
from litquarry.session import materialize

SHARDS = 24
LAST_ITEMS = 40_000
"""Most bundles the last differencing, a single task, gets besides the large groups."""
CELL_ITEMS = 20_000
"""Most items one task differences on the way there, on average."""
LARGE = 1_000
"""A group of more than a LARGE-th of a shard's share is never bundled: at most shards * LARGE are."""
SLOT_CELL = 4_096
"""Rows numbered together, on average."""


def differencing(sizes: Sequence[int], parts: int) -> list[int]:
    """The part, 0 to ``parts`` - 1, of each item, by Karmarkar-Karp differencing.

    Each item starts as a partition with its size in one part and nothing in the others. The two
    partial partitions with the largest spread are combined, the largest part of one with the
    smallest of the other, until one is left. Equal spreads go by position, so the result is fixed.
    """
    n = len(sizes)
    if not n:
        return []
    sums = {i: [size, *[0] * (parts - 1)] for i, size in enumerate(sizes)}
    heap = [(-size if parts > 1 else 0, i) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    joins = []
    slots = range(parts)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        both = [x + y for x, y in zip(sums.pop(a), reversed(sums.pop(b)))]
        order = sorted(slots, key=both.__getitem__, reverse=True)
        node = n + len(joins)
        joins.append((a, b, bytes(order) if parts <= 256 else order))
        sums[node] = [both[t] for t in order]
        heapq.heappush(heap, (both[order[-1]] - both[order[0]], node))
    labels = {heap[0][1]: list(slots)}
    for node in range(n + len(joins) - 1, n - 1, -1):
        a, b, order = joins[node - n]
        left, right = [0] * parts, [0] * parts
        for label, t in zip(labels.pop(node), order):
            left[t] = label
            right[parts - 1 - t] = label
        labels[a] = left if a >= n else left[0]
        labels[b] = right if b >= n else right[0]
    return [labels[i] if n > 1 else 0 for i in range(n)]


def _difference_cells(items: DataFrame, parts: int) -> DataFrame:
    """(item, cell, part) with every cell differenced in a task of its own."""

    def one_cell(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("item", ignore_index=True)
        return pd.DataFrame({
            "item": frame["item"], "cell": frame["cell"], "size": frame["size"],
            "part": differencing(frame["size"].tolist(), parts),
        })

    return items.groupBy("cell").applyInPandas(one_cell, "item string, cell long, size long, part int")


def assign_groups(groups: DataFrame, shards: int) -> DataFrame:
    """(item, shard) of each group, from (item, size): text identities and total bytes.

    Small groups are first bundled. A round deals the items to cells by hash, differences each cell
    into ``shards`` parts and makes every part one item of the next round, until at most LAST_ITEMS
    bundles are left. Groups too large to be balanced by bundles skip the rounds. The last
    differencing takes the bundles and these groups, whose number has a bound that does not depend
    on the table, and names the shard of each.
    """
    total, count = groups.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    bar = total // (shards * LARGE)
    items = groups.filter(F.col("size") <= bar)
    last = groups.filter(F.col("size") > bar)
    rounds = []
    while count > LAST_ITEMS:
        cell_items = min(CELL_ITEMS, -(-count // LAST_ITEMS) * shards)
        cells = -(-count // cell_items)
        placed = materialize(
            _difference_cells(items.withColumn("cell", F.pmod(F.xxhash64("item"), F.lit(cells))), shards).withColumn(
                "bundle", F.format_string("%d:%d:%d", F.lit(len(rounds)), "cell", "part")
            ),
            "bundles",
        )
        rounds.append(placed.select("item", "bundle"))
        items = placed.groupBy(F.col("bundle").alias("item")).agg(F.sum("size").alias("size"))
        count = cells * shards
    last = _difference_cells(last.unionByName(items).withColumn("cell", F.lit(0).cast("long")), shards)
    found = materialize(last.select("item", F.col("part").alias("shard")), "shards")
    for placed in reversed(rounds):
        down = placed.join(found.withColumnRenamed("item", "bundle"), "bundle").select("item", "shard")
        found = found.filter(~F.col("item").rlike("^[0-9]+:[0-9]+:[0-9]+$")).unionByName(down)
    return found


def byte_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every row.

    Size is the UTF-8 bytes of the text plus 8; a null text has no bytes and shares the group of
    empty texts. Rows of equal texts, repeated rows included, share a shard, which has slots 0 to
    its number of rows less one. Null ids are numbered like others. An empty table gives an empty
    result; other columns are not read. The law is ``bytes``, so ``grown_shard`` is null.
    """
    text = text_or_empty()
    rows = materialize(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.monotonically_increasing_id().alias("row"),
            (F.octet_length(text) + 8).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.sha2(text, 256).alias("item"),
        ),
        "sizes",
    )
    groups = materialize(rows.groupBy("item").agg(F.sum("size").alias("size")), "groups")
    cells = max(1, rows.count() // (shards * SLOT_CELL))
    placed = materialize(
        rows.join(assign_groups(groups, shards), "item").select(
            "doc_id", "row", "size", "text_crc32", "shard",
            F.pmod(F.xxhash64("doc_id", "row"), F.lit(cells)).alias("cell"),
        ),
        "placed",
    )
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("shard", "cell").count().select(
        "shard", "cell", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start")
    )
    place = Window.partitionBy("shard", "cell").orderBy("doc_id", "row")
    return (
        placed.withColumn("place", F.row_number().over(place) - 1)
        .join(starts, ["shard", "cell"])
        .select(
            "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
            (F.col("start") + F.col("place")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        )
    )


@query()
def op1_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_shards(documents(spark, sf_dir))
