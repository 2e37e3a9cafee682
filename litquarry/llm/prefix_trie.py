"""Trie of conversation prefixes: a count-min sketch of prefix digests tells which need no shuffle."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from litquarry.llm.common import power_of_two, shuffle_partitions, text_or_empty, worker_model
from litquarry.llm.registry import query
from litquarry.session import materialize

HEAD = 3
"""Most turns that a rebuilt conversation takes from another one."""
FAMILY = 20
"""Conversations that may take turns from the same one."""
SKETCH_ROWS = 4
SKETCH_WIDTH = 1 << 22
"""Most counters of a row of the sketch, a byte each; more prefixes than that only send more of them to the exact grouping."""
CHUNK = 4096
"""Counters that are merged together."""
IDS = 256
"""Range of ids that are joined to one text before they are hashed."""

PRIME = (1 << 127) - 1
BASE = 0x5D3F8A16C97B20E4F1A6843B9D05C7E3 % PRIME
"""Digest of a sequence: the sum of each turn's digest times BASE to the power of its place, modulo PRIME."""
ROOT = bytes(16)

WORD = "[^\\x20\\x09-\\x0D]+"

SORTED = "piece int, conv long, place long, words long, before long, value binary, prior binary"
"""Turns in order: place, words, words of the turns before, digest with and without this turn."""
PREFIX = "conv long, depth long, value binary, prior binary, before long, words long, length long, total long"
"""Prefixes: digests with and without the last turn, words before and in it, turns and words of the whole conversation."""


def _number(digest: bytes) -> int:
    return int.from_bytes(digest, "big")


def _bytes(number: int) -> bytes:
    return number.to_bytes(16, "big")


def _turns(conversations: DataFrame) -> DataFrame:
    """conv, turn, digest and words of every turn that has a conversation."""
    role, text = text_or_empty("role"), text_or_empty("text")
    digest = F.unhex(F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256), 1, 32))
    return conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), digest.alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"), F.monotonically_increasing_id().alias("row"),
    )


def _sorted_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Place, words before and digests of each turn, counted from where its conversation begins in this partition."""
    piece = TaskContext.get().partitionId()
    last = None
    for batch in batches:
        places, befores, values, priors = [], [], [], []
        for conv, digest, words in zip(*(batch.column(c).to_pylist() for c in ("conv", "digest", "words"))):
            if conv != last:
                last, place, before, value, power = conv, 0, 0, 0, 1
            place += 1
            power = power * BASE % PRIME
            places.append(place)
            befores.append(before)
            priors.append(_bytes(value))
            value = (value + _number(digest) * power) % PRIME
            values.append(_bytes(value))
            before += words
        yield pa.RecordBatch.from_arrays([
            pa.array([piece] * batch.num_rows, pa.int32()), batch.column("conv"), pa.array(places, pa.int64()), batch.column("words"),
            pa.array(befores, pa.int64()), pa.array(values, pa.binary()), pa.array(priors, pa.binary()),
        ], names=["piece", "conv", "place", "words", "before", "value", "prior"])


def _carries(pieces: DataFrame) -> dict[tuple[int, int], tuple[int, int, int]]:
    """Turns, words and digest of the part of a piece's first conversation that lies in earlier pieces; one row a piece is collected."""
    end = F.max(F.struct("conv", "place", (F.col("before") + F.col("words")).alias("words"), "value")).alias("end")
    carried, out = None, {}
    for r in sorted(pieces.groupBy("piece").agg(F.min("conv").alias("first"), end).collect(), key=lambda r: r["piece"]):
        conv, turns, words, value = r["end"]
        value = _number(bytes(value))
        if carried and carried[0] == r["first"]:
            out[r["piece"], r["first"]] = carried[1:]
            if conv == r["first"]:
                turns, words, value = (
                    carried[1] + turns, carried[2] + words, (carried[3] + pow(BASE, carried[1], PRIME) * value) % PRIME,
                )
        carried = (conv, turns, words, value)
    return out


def placed_turns(conversations: DataFrame, partitions: int | None = None) -> DataFrame:
    """conv, place, words, before, value and prior of every turn.

    The turns are sorted as a whole, so a very long conversation is spread over many tasks; each
    counts and digests its own part, and what lies before it is added afterwards. Only digests
    and counts are sorted, no texts.
    """
    turns = materialize(_turns(conversations), "turns")
    partitions = partitions or shuffle_partitions(conversations.sparkSession)
    order = ["conv", F.col("turn").asc_nulls_first(), "digest", "row"]
    dealt = turns.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    pieces = materialize(dealt.select("conv", "digest", "words").mapInArrow(_sorted_pieces, SORTED), "pieces")
    carries = _carries(pieces)

    def carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = zip(batch.column("piece").to_pylist(), batch.column("conv").to_pylist())
            changed = {i: carries[k] for i, k in enumerate(keys) if k in carries}
            if changed:
                columns = {c: batch.column(c).to_pylist() for c in batch.schema.names}
                powers = {turns: pow(BASE, turns, PRIME) for turns, _, _ in set(changed.values())}
                for i, (turns, words, value) in changed.items():
                    columns["place"][i] += turns
                    columns["before"][i] += words
                    for name in ("value", "prior"):
                        columns[name][i] = _bytes((value + powers[turns] * _number(columns[name][i])) % PRIME)
                batch = pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in batch.schema], schema=batch.schema)
            yield batch

    return materialize(pieces.mapInArrow(carry, SORTED), "placed").drop("piece") if carries else pieces.drop("piece")


def _rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Prefixes that end in a conversation's own turns, after those it has taken from another one."""
    shift = [pow(BASE, -k, PRIME) for k in range(HEAD + 1)]
    for batch in batches:
        rows = batch.to_pylist()
        out = {name: [] for name in ("value", "prior")}
        for r in rows:
            taken, own, factor = _number(r["taken_value"]), _number(r["own_value"]), shift[r["own"] - r["taken"]]
            for name in out:
                out[name].append(_bytes((taken + (_number(r[name]) - own) * factor) % PRIME))
        yield pa.RecordBatch.from_arrays([
            batch.column("conv"), pa.array([r["place"] - r["own"] + r["taken"] for r in rows], pa.int64()),
            pa.array(out["value"], pa.binary()), pa.array(out["prior"], pa.binary()),
            pa.array([r["before"] - r["own_words"] + r["taken_words"] for r in rows], pa.int64()),
            *(batch.column(c) for c in ("words", "length", "total")),
        ], names=["conv", "depth", "value", "prior", "before", "words", "length", "total"])


def conversations_of(placed: DataFrame, heads: Column) -> DataFrame:
    """conv, its length and total words after it has taken its first ``heads`` turns from its family's first conversation.

    ``heads`` is a column over conv, from 0 to HEAD. ``own`` turns of the conversation itself fall
    away for the ``taken`` ones; digests and words of both and the taken turns are kept.
    """
    turn = F.struct("place", "value", "prior", "before", "words")
    each = materialize(
        placed.groupBy("conv").agg(
            F.max("place").alias("n"), F.sum("words").alias("all_words"),
            F.array_sort(F.collect_list(F.when(F.col("place") <= HEAD, turn))).alias("first"),
        ),
        "conversations",
    )
    from_ = each.select(F.col("conv").alias("from"), F.col("first").alias("from_first"))
    both = each.withColumn("own", heads.cast("int")).withColumn("from", F.col("conv") - F.col("conv") % FAMILY).join(from_, "from", "left")
    both = both.withColumn("turns", F.coalesce(F.slice("from_first", F.lit(1), F.col("own")), F.array().cast(each.schema["first"].dataType)))
    taken, own = F.try_element_at("turns", F.lit(-1)), F.when(F.col("own") > 0, F.try_element_at("first", F.greatest("own", F.lit(1))))
    none, left = F.lit(ROOT), F.col("n") > F.col("own")

    def words(turn: Column) -> Column:
        return F.coalesce(turn["before"] + turn["words"], F.lit(0).cast("long"))

    return both.select(
        "conv", "own", F.size("turns").alias("taken"), "turns",
        F.coalesce(taken["value"], none).alias("taken_value"), words(taken).alias("taken_words"),
        F.coalesce(own["value"], none).alias("own_value"), words(own).alias("own_words"),
        (F.size("turns") + F.greatest(F.col("n") - F.col("own"), F.lit(0))).cast("long").alias("length"),
        (words(taken) + F.when(left, F.col("all_words") - words(own)).otherwise(0)).alias("total"),
    )


def prefixes(placed: DataFrame, each: DataFrame) -> DataFrame:
    """A row PREFIX for every conversation and depth from 1."""
    taken = each.select("conv", "length", "total", F.inline("turns")).select(
        "conv", F.col("place").alias("depth"), "value", "prior", "before", "words", "length", "total"
    )
    own = placed.join(each.drop("turns"), "conv").filter("place > own").mapInArrow(_rest, PREFIX)
    return materialize(taken.unionByName(own), "prefixes")


def _halves(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, 2)


def _counters(halves: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """Places of the digests' counters in each row of the sketch."""
    for k in range(SKETCH_ROWS):
        yield (halves[:, 0] + np.uint64(k) * (halves[:, 1] | np.uint64(1))) & np.uint64(width - 1)


def sketch(rows: DataFrame, width: int) -> np.ndarray:
    """Count-min sketch of ``value``, counters ending at 2: no digest is counted less often than it occurs, up to 2.

    ``width`` is a power of two and at most SKETCH_WIDTH, so the sketch that comes to the driver
    has at most SKETCH_ROWS times that many bytes, whatever the data. Tasks send chunks of counters
    that are not all zero, and the chunks are added up by place.
    """
    chunk = min(width, CHUNK)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = np.zeros((SKETCH_ROWS, width), np.uint8)
        for batch in batches:
            for row, places in zip(made, _counters(_halves(batch.column("value")), width)):
                found, times = np.unique(places, return_counts=True)
                row[found] = np.minimum(row[found] + np.minimum(times, 2), 2)
        chunks = made.reshape(-1, chunk)
        for at in np.flatnonzero(chunks.any(1)).tolist():
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([chunks[at].tobytes()], pa.binary())], names=["at", "counters"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, total = None, None
        for batch in batches:
            for at, counters in zip(batch.column("at").to_pylist(), batch.column("counters").to_pylist()):
                found = np.frombuffer(counters, np.uint8)
                if at != last:
                    if last is not None:
                        yield whole(last, total)
                    last, total = at, found
                else:
                    total = np.minimum(total + found, 2).astype(np.uint8)
        if last is not None:
            yield whole(last, total)

    def whole(at: int, total: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["at", "counters"])

    kind = "at long, counters binary"
    parts = rows.select("value").mapInArrow(count, kind)
    merged = parts.repartition("at").sortWithinPartitions("at").mapInArrow(add, kind)
    made = np.zeros((SKETCH_ROWS * width // chunk, chunk), np.uint8)
    for at, counters in merged.collect():
        made[at] = np.frombuffer(bytes(counters), np.uint8)
    return made.reshape(SKETCH_ROWS, width)


def screened(rows: DataFrame, counters: np.ndarray) -> DataFrame:
    """The prefixes with ``single`` and ``prior_single``: whether the sketch proves that no other conversation has them."""
    handle, key = rows.sparkSession.sparkContext.broadcast(counters), uuid.uuid4().hex

    def alone(column: pa.Array, made: np.ndarray) -> pa.Array:
        found = np.full(len(column), 2, np.uint8)
        for row, places in zip(made, _counters(_halves(column), made.shape[1])):
            found = np.minimum(found, row[places])
        return pa.array(found < 2)

    def screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = worker_model(("prefix sketch", key), lambda: handle.value)
        for batch in batches:
            flags = [alone(batch.column("value"), made), alone(batch.column("prior"), made)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *flags], names=[*batch.schema.names, "single", "prior_single"])

    return rows.mapInArrow(screen, PREFIX + ", single boolean, prior_single boolean").withColumn(
        "prior_single", F.col("prior_single") & (F.col("depth") > 1)
    )


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the joined texts of each value, from a stream sorted by value and place; holds one batch."""
    last, state = None, None

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([last], pa.binary()), pa.array([state.hexdigest()])], names=["value", "ends_sha256"])

    for batch in batches:
        for value, text in zip(batch.column("value").to_pylist(), batch.column("ids").to_pylist()):
            if value != last:
                if last is not None:
                    yield done()
                last, state = value, hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
    if last is not None:
        yield done()


def _ends(ended: DataFrame) -> DataFrame:
    """value and ends_sha256, from (value, conv) of the conversations that end at each node.

    At most IDS ids of one range are joined in an aggregate; the hash of a node must read its ids in
    order, so the joined texts of one node go through one task as a sorted stream.
    """
    part = F.floor(F.col("conv") / IDS)
    joined = ended.groupBy("value", part.alias("part")).agg(F.array_join(F.array_sort(F.collect_list("conv")).cast("array<string>"), ",").alias("ids"))
    return joined.repartition("value").sortWithinPartitions("value", "part").select("value", "ids").mapInArrow(_hashed, "value binary, ends_sha256 string")


def trie(rows: DataFrame, each: DataFrame) -> DataFrame:
    """The nodes, from prefixes and (conv, length, total) of every conversation.

    A conversation is at home at the nodes of which it is the smallest member; these are the deepest of
    its nodes, from some depth on. What a node sums over its subtree is then a sum over its members:
    a member's turns that are not at its home repeat a turn of another, a leaf is counted by the
    member that is at home there, and a child by the member that is at home in it. So no level
    is handled after another.
    """
    spark = rows.sparkSession
    empty = hashlib.sha256(b"").hexdigest()
    width = min(SKETCH_WIDTH, power_of_two(2 * rows.count() + 1))
    marked = screened(rows, sketch(rows, width))
    exact = materialize(marked.filter("not single"), "maybe_shared")
    heads = materialize(marked.filter("single and not prior_single"), "tail_heads")

    grouped = materialize(exact.groupBy("value", "depth").agg(
        F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
        F.count_if(F.col("depth") == F.col("length")).alias("n_ends"), F.first("prior").alias("prior"),
    ), "nodes")
    home = grouped.select("value", F.col("conv_id").alias("smallest"), (F.col("n_convs") == F.col("n_ends")).alias("childless"))
    at_node = exact.join(home, "value").select(
        "conv", "depth", "before", "length", "total", (F.col("conv") == F.col("smallest")).alias("at_home"), "childless"
    )
    at_tail = heads.select("conv", "depth", "before", "length", "total", F.lit(True).alias("at_home"), F.lit(True).alias("childless"))
    # A tail's own last node is childless, so a conversation with a tail is the one at home in a leaf.
    tailed = F.lit(False)
    homes = at_node.withColumn("tail", tailed).unionByName(at_tail.withColumn("tail", ~tailed)).groupBy("conv").agg(
        F.min(F.when(F.col("at_home"), F.struct("depth", "before"))).alias("home"), F.first("length").alias("length"), F.first("total").alias("total"),
        F.bool_or(F.col("tail") | (F.col("at_home") & F.col("childless") & (F.col("depth") == F.col("length")))).alias("leaf"),
    )
    homes = materialize(homes.select(
        "conv", "length", "leaf", F.coalesce("home.depth", F.col("length") + 1).alias("home"), F.coalesce("home.before", "total").alias("away")
    ), "homes")

    sums = exact.select("value", "conv", "depth", "before").join(homes, "conv").groupBy("value").agg(
        F.sum(F.greatest(F.col("away") - F.col("before"), F.lit(0))).alias("saved_tokens"),
        F.count_if((F.col("home") <= F.col("depth") + 1) & (F.col("depth") < F.col("length"))).alias("n_children"),
        F.count_if("leaf").alias("n_leaves"),
    )
    root = each.agg(F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.count_if(F.col("length") == 0).alias("n_ends"))
    below = homes.agg(
        F.coalesce(F.sum("away"), F.lit(0)).alias("saved_tokens"), F.count_if(F.col("home") <= 1).alias("n_children"), F.count_if("leaf").alias("leaves")
    )
    first = root.first()
    if not first["n_convs"]:
        return spark.createDataFrame([], NODE)
    top = below.select(
        F.lit(ROOT).alias("value"), F.lit(first["conv_id"]).alias("conv_id"), F.lit(0).cast("long").alias("depth"),
        F.lit(None).cast("long").alias("parent_conv_id"), F.lit(first["n_convs"]).alias("n_convs"), "n_children",
        F.when(F.lit(first["n_convs"] == first["n_ends"]), F.lit(1).cast("long")).otherwise(F.col("leaves")).alias("n_leaves"), "saved_tokens",
    )

    parent = grouped.select(F.col("value").alias("prior"), F.col("conv_id").alias("above"))
    inner = grouped.select("value", "prior", "conv_id", "depth", "n_convs", F.lit(False).alias("single"), "n_ends").unionByName(
        heads.select("value", "prior", F.col("conv").alias("conv_id"), "depth", F.lit(1).cast("long").alias("n_convs"), F.lit(True).alias("single"), (F.col("depth") == F.col("length")).cast("long").alias("n_ends"))
    )
    above = F.when(F.col("depth") == 1, F.lit(first["conv_id"])).otherwise(F.coalesce("above", "conv_id"))
    inner = materialize(inner.join(parent, "prior", "left").withColumn("parent_conv_id", above).drop("prior", "above"), "parents")
    ended = exact.filter("depth = length").select("value", "conv").unionByName(each.filter("length = 0").select(F.lit(ROOT).alias("value"), "conv"))
    shared = inner.filter("not single").drop("single", "n_ends").join(sums, "value").select(*top.columns).unionByName(top)
    shared = shared.join(_ends(ended), "value", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(empty))).drop("value")

    def alone(conv_id: str, parent: Column, has_end: Column) -> list[Column]:
        one, own = F.lit(1).cast("long"), F.sha2(F.col(conv_id).cast("string").cast("binary"), 256)
        return [
            F.col(conv_id).alias("conv_id"), F.col("depth"), parent.alias("parent_conv_id"), one.alias("n_convs"),
            F.when(has_end, F.lit(0)).otherwise(1).cast("long").alias("n_children"), one.alias("n_leaves"),
            F.lit(0).cast("long").alias("saved_tokens"), F.when(has_end, own).otherwise(F.lit(empty)).alias("ends_sha256"),
        ]

    tails = inner.filter("single").select(*alone("conv_id", F.col("parent_conv_id"), F.col("n_ends") == 1)).unionByName(
        marked.filter("single and prior_single").select(*alone("conv", F.col("conv"), F.col("depth") == F.col("length")))
    )
    return shared.unionByName(tails)


NODE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
)


def prefix_trie(conversations: DataFrame, heads: Column | None = None, partitions: int | None = None) -> DataFrame:
    """A row NODE for every distinct sequence of a conversation's first turns, the empty one included.

    ``heads``, a column over conv from 0 to HEAD, makes each conversation take that many first
    turns from the first of its FAMILY, as many as that has; None takes the conversations as they are.
    Turns are equal if role and text are; a null counts as empty, and texts may be of any length.
    Turns are in order of ``turn``, null first; those with the same number are in the order of a
    hash of role and text, and repeated rows are turns of their own. Rows with a null conv_id
    belong to no conversation and are left out. Two sequences count as the same if their 127-bit
    digests are. An empty table gives an empty result; other columns are not read.
    """
    placed = placed_turns(conversations.select("conv_id", "turn", "role", "text"), partitions)
    each = materialize(conversations_of(placed, F.lit(0) if heads is None else heads), "rebuilt")
    return trie(prefixes(placed, each), each.select("conv", "length", "total"))


_CRC = (
    "list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(CAST(c AS VARCHAR), ''), "
    "lambda b: [CAST(ascii(b) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))), lambda x, y: xor(xor(x, y) >> 1, 3988292384 * (xor(x, y) & 1)))"
)


@query(f"""
    WITH t AS (
        SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS p, coalesce(role, '') AS role, coalesce(text, '') AS text
        FROM conversations WHERE conv_id IS NOT NULL
    ), n AS (SELECT c, max(p) AS n FROM t GROUP BY c),
    h AS (SELECT c, n, c - c % {FAMILY} AS b, xor({_CRC}, 4294967295) % 4 AS h FROM n),
    m AS (SELECT h.c, h.b, h.h, least(h.h, coalesce(f.n, 0)) AS m FROM h LEFT JOIN n AS f ON f.c = h.b),
    r AS (
        SELECT m.c, t.p AS d, role, text FROM m JOIN t ON t.c = m.b AND t.p <= m.m
        UNION ALL SELECT m.c, m.m + t.p - m.h, role, text FROM m JOIN t ON t.c = m.c AND t.p > m.h
    ), k AS (
        SELECT c, d, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS w,
               string_agg(sha256(sha256(role) || sha256(text)), '') OVER (PARTITION BY c ORDER BY d) AS path FROM r
        UNION ALL SELECT c, 0, 0, '' FROM n
    ), e AS (SELECT k.path, k.c FROM k JOIN (SELECT c, max(d) AS d FROM k GROUP BY c) AS z USING (c, d)),
    nodes AS (SELECT path, d, min(c) AS conv_id, count(*) AS n_convs, any_value(w) AS w FROM k GROUP BY path, d),
    children AS (SELECT path[:64 * (d - 1)] AS path, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
    sums AS (
        SELECT x.path, count_if(n_children IS NULL) AS n_leaves, sum((y.n_convs - 1) * y.w) AS saved_tokens
        FROM nodes AS y LEFT JOIN children USING (path) JOIN k AS x ON x.c = y.conv_id AND x.d <= y.d GROUP BY x.path
    ), ends AS (SELECT path, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS ids FROM e GROUP BY path)
    SELECT o.conv_id, CAST(o.d AS BIGINT) AS depth, u.conv_id AS parent_conv_id, o.n_convs, coalesce(n_children, 0) AS n_children,
           CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
    FROM nodes AS o JOIN sums USING (path) LEFT JOIN children USING (path) LEFT JOIN ends USING (path)
    LEFT JOIN nodes AS u ON o.d > 0 AND u.path = o.path[:64 * (o.d - 1)]
""")
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    heads = F.crc32(F.col("conv").cast("string").cast("binary")) % 4
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"), heads)
