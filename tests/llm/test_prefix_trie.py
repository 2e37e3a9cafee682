"""The trie against one built turn by turn in plain Python."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from litquarry.llm import prefix_trie as pt

def heads():
    return F.crc32(F.col("conv").cast("string").cast("binary")) % 4



def plain(rows, rebuild):
    turns = {}
    for c, turn, role, text in rows:
        if c is not None:
            turns.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in turns.items()}
    made = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4 if rebuild else 0
        made[c] = own.get(c - c % 20, [])[:h] + ts[h:]
    members = {}
    for c, ts in made.items():
        for d in range(len(ts) + 1):
            members.setdefault(tuple(ts[:d]), []).append(c)
    out = []
    for node, inside in members.items():
        below = [n for n in members if n[:len(node)] == node]
        ends = sorted(c for c in inside if len(made[c]) == len(node))
        children = [n for n in below if len(n) == len(node) + 1]
        out.append((
            min(inside), len(node), min(members[node[:-1]]) if node else None, len(inside), len(children),
            sum(not any(m != n and m[:len(n)] == n for m in below) for n in below),
            sum((len(members[n]) - 1) * len(re.findall(r"[^\x20\x09-\x0d]+", n[-1][1])) for n in below if n),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def conversations(draw, count):
    """Few texts, so prefixes are shared; one conversation holds a third of the turns, many are copies, some have no turn left."""
    rows = []
    for c in draw.sample([c for c in range(200) if c not in (40, 41)], count):
        for turn in range(draw.choice([1, 1, 2, 3, 4, 6])):
            rows.append((c, turn, draw.choice(["user", "user", "assistant"]), draw.choice(["a", "b c", "b c", ""])))
    for c in range(300, 300 + count // 3):
        rows += [(c, turn, "user", f"copy {turn}") for turn in range(3)]
    rows += [(40, turn, "user", f"long {turn % 3} x") for turn in range(len(rows) // 2)]
    rows += [(41, turn, "user", f"long {turn % 3} x") for turn in range(30)]
    rows += [(None, 0, "user", "none"), (None, 1, None, None), (-21, None, None, None), (-21, 0, "", ""), (-41, 5, "user", "x" * 100_000)]
    return list(dict.fromkeys(rows))


def table(spark, rows):
    made = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    for name in ("conv", "value", "place", "depth", "row", "a.b"):
        made = made.withColumn(name, F.lit("clash"))
    return made


@pytest.mark.parametrize("width, rebuild", [(1 << 22, True), (1 << 22, False), (64, True), (4, True)])
def test_trie_against_plain(spark, monkeypatch, width, rebuild):
    monkeypatch.setattr(pt, "SKETCH_WIDTH", width)  # a small sketch proves little, and the result stays
    monkeypatch.setattr(pt, "IDS", 16)
    rows = conversations(random.Random(width + rebuild), 60)
    found = pt.prefix_trie(table(spark, rows), heads() if rebuild else None, 7).collect()
    assert sorted((tuple(r) for r in found), key=str) == plain(rows, rebuild)


def test_long_conversation_is_cut_into_pieces(spark):
    rows = [(7, turn, "user", f"t {turn}") for turn in range(500)] + [(8, turn, "user", f"t {turn}") for turn in range(40)]
    cut = {(r["conv"], r["place"]): bytes(r["value"]) for r in pt.placed_turns(table(spark, rows), 9).collect()}
    whole = {(r["conv"], r["place"]): bytes(r["value"]) for r in pt.placed_turns(table(spark, rows), 1).collect()}
    assert cut == whole and len(cut) == 540 and all(cut[7, p] == cut[8, p] for p in range(1, 41))


def test_repeated_and_tied_turns(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, 0, "user", "a"), (2, 1, "user", "a"), (2, 1, "user", "a")]
    found = sorted(tuple(r)[:7] for r in pt.prefix_trie(table(spark, rows)).collect())
    assert found == [(1, 0, None, 2, 1, 1, 2), (1, 1, 1, 2, 1, 1, 2), (1, 2, 1, 2, 1, 1, 1), (1, 3, 1, 1, 0, 1, 0)]


def test_no_turns(spark):
    assert pt.prefix_trie(table(spark, [(1, 0, "user", "a")]).limit(0)).collect() == []
    assert pt.prefix_trie(table(spark, [(None, 0, "user", "a")])).collect() == []


def test_sketch_never_counts_too_little(spark):
    draw = random.Random(4)
    values = [draw.randbytes(16) for _ in range(500)]
    rows = [(v,) for i, v in enumerate(values) for _ in range(1 + i % 2)]
    counters = pt.sketch(spark.createDataFrame(rows, "value binary").repartition(4), 256)
    import pyarrow as pa

    halves = pt._halves(pa.array(values[1::2], pa.binary()))
    assert all((row[places] == 2).all() for row, places in zip(counters, pt._counters(halves, 256)))
