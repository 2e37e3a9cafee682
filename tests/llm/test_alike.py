"""Near copies that bands bring together, in lines and documents."""

import os
import random
import re
import string

from pyspark.sql import functions as F

import corpus_pipeline
from conftest import plan_of, rows
from litquarry import session
from litquarry.llm import alike, line_dedup, simhash
from litquarry.session import materialize, materialize_all


def words(draw, n, size):
    return " ".join("".join(draw.choices(string.ascii_lowercase, k=size)) for _ in range(n))


def table(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)


def test_pairs_in_one_band_are_found_whatever_its_leaders(spark):
    draw = random.Random(1)
    firsts = [words(draw, 4, 10) for _ in range(40)]
    docs = table(spark, [t for f in firsts for t in (f, f[:-1] + "#")])
    lines = line_dedup._lines(docs).withColumn("bands", F.array(F.lit(0).cast("long")))
    lines = materialize(lines, "lines")
    by_hash = {r["h1"]: r["norm"][:-1] for r in lines.collect()}
    links = [(by_hash[r["a"]], by_hash[r["b"]]) for r in line_dedup.similar_lines(docs, lines).collect() if r["a"] != r["b"]]
    assert {a for a, b in links} == {f[:-1] for f in firsts} and all(a == b for a, b in links)


def test_short_lines_and_lines_without_spaces(spark):
    draw = random.Random(2)
    made = [words(draw, 3, 14) for _ in range(60)] + ["https://" + words(draw, 1, 40) for _ in range(60)]
    made += [words(draw, 1, 45).translate({ord(c): ord(c) + 0x3d0 for c in string.ascii_lowercase}) for _ in range(60)]
    found = line_dedup.decisions(table(spark, [t for m in made for t in (m, "#" + m[1:])])).collect()
    gone = sorted(r["doc_id"] for r in found if r["n_dropped"])
    assert all(i % 2 for i in gone) and len(gone) >= 0.97 * len(made)


def test_near_stage_takes_copies_of_four_fifths(spark):
    draw = random.Random(3)
    made = [words(draw, 200, 6).split() for _ in range(40)]

    def copy(text, places):
        return [w + "#" if i in places else w for i, w in enumerate(text)]

    near = [copy(t, {20, 60, 100, 140}) for t in made]  # 176 of 216 shingles
    far = [copy(t, {20, 60, 100, 140, 180}) for t in ([w + "*" for w in t] for t in made)]
    other = [[w + "*" for w in t] for t in made]  # 171 of 221 shingles with far
    kept = simhash.near_dedup(table(spark, [" ".join(t) for t in made + near + other + far])).collect()
    ids = {r["doc_id"] for r in kept}
    assert ids >= set(range(40)) | set(range(80, 160)) and len(ids) <= 122


def test_near_stage_takes_what_fingerprints_link(spark):
    draw = random.Random(4)
    base, pairs = words(draw, 24, 6).split(), []
    for i in range(400):
        made = [w + str(i) for w in base[:20]] + base[20:]
        other = made[:19] + ["x" + made[19]] + made[20:]  # three of 20 five-word shingles fewer than alike
        pairs.append((" ".join(made), " ".join(other)))
    linked = [(a, b) for a, b in pairs if (simhash.fingerprint(a) ^ simhash.fingerprint(b)).bit_count() <= simhash.DISTANCE]
    assert linked
    texts = [t for pair in linked for t in pair]
    kept = [r["doc_id"] for r in corpus_pipeline.remove_near_copies(spark, table(spark, texts), "").collect()]
    assert not any(i % 2 for i in kept)


def test_lines_of_one_template_do_not_meet_in_it(spark):
    draw = random.Random(5)
    template = words(draw, 8, 8)
    made = [template + " " + words(draw, 3, 8) for _ in range(60)]
    made += [m[:-1] + "#" for m in made[:20]]
    texts = spark.createDataFrame(list(enumerate(made)), "h1 long, norm string")
    members = texts.selectExpr("0L AS band", "h1", "h1 AS root")
    found = {tuple(r) for r in alike._pairs_by_prefix(members, texts, line_dedup.shingles, 0.8).collect()}
    assert found >= {(i, 60 + i) for i in range(20)} and len(found) < 40


def test_prefix_pairs_miss_none(spark):
    draw = random.Random(6)
    base = words(draw, 7, 6)
    made = sorted({"".join(draw.choice("xyz") if draw.random() < p else c for c in base[: draw.randint(36, 48)]) for p in (0.01, 0.03) for _ in range(80)})
    texts = spark.createDataFrame(list(enumerate(made)), "h1 long, norm string")
    members = texts.selectExpr("0L AS band", "h1", "h1 AS root")
    sets = [{m[i:i + 5] for i in range(len(m) - 4)} for m in made]
    alike_ = {(i, j) for j in range(len(made)) for i in range(j) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9}
    found = {tuple(r) for r in alike._pairs_by_prefix(members, texts, line_dedup.shingles, 0.8).collect()}
    assert alike_ and found >= alike_


def test_members_of_one_center_meet_in_what_sets_them_apart(spark):
    draw = random.Random(7)
    base = words(draw, 25, 8).split()
    near = [" ".join(base[:i] + [words(draw, 1, 8)] + base[i + 1:]) for i in range(25) for _ in range(6)]
    cut = [" ".join(base[2:i] + [words(draw, 1, 8)] + base[i + 1:j] + base[j + 1:]) for i in range(4, 12) for j in range(14, 24)]
    made = [" ".join(base)] + near + cut
    texts = spark.createDataFrame([(i, t, 9 if i == 0 else 1) for i, t in enumerate(made)], "h1 long, norm string, times long")
    members = texts.selectExpr("0L AS band", "h1", f"IF(h1 <= {len(near)}, 0L, h1) AS root")
    sets = [{m[i:i + 5] for i in range(len(m) - 4)} for m in made]
    alike_ = {(i, j) for j in range(len(near) + 1, len(made)) for i in range(j) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9}
    found = {tuple(r) for r in alike._pairs_by_prefix(members, texts, line_dedup.shingles, 0.8).collect()}
    assert alike_ and found >= alike_
    assert len(found) < len(cut) * len(near) / 12


def test_near_signatures_take_one_python_worker_a_task(spark, monkeypatch):
    written = {}
    monkeypatch.setattr(simhash, "materialize", lambda df, name: written.setdefault(name, plan_of(df)) and materialize(df, name))
    texts = ["a b c d e f", "a b c d e f", None, "ÄÖ Ü x"]
    corpus_pipeline.remove_near_copies(spark, table(spark, texts), "").collect()
    assert len(re.findall(r"^\(\d+\) ArrowEvalPython", written["prints"], re.M)) == 1


def broadcasts(plan, key):
    """The joins of a plan whose first key is ``key`` and that send a side to all executors."""
    return re.findall(rf"^\(\d+\) BroadcastHashJoin.*\nLeft keys \[\d\]: \[{key}#", plan, re.M)


def test_exploded_variants_are_not_broadcast(spark):
    prints = materialize(spark.range(500).select(F.xxhash64("id").alias("fp")), "fingerprints")
    plan = plan_of(simhash.links(prints))
    assert re.search(r"SortMergeJoin.*\nLeft keys \[1\]: \[key#", plan) and not broadcasts(plan, "key")


def test_exploded_differences_are_not_broadcast(spark, monkeypatch):
    written = {}
    monkeypatch.setattr(alike, "materialize", lambda df, name: written.setdefault(name, plan_of(df)) and materialize(df, name))
    draw = random.Random(8)
    base = words(draw, 25, 8).split()
    made = [" ".join(base[:i] + [words(draw, 3, 8)] + base[i + 6:]) for i in range(20)]
    texts = spark.createDataFrame(list(enumerate(made)), "h1 long, norm string")
    members = texts.selectExpr("0L AS band", "h1", "h1 AS root")
    pairs = alike._pairs_by_prefix(members, texts, line_dedup.shingles, 0.8)
    assert not broadcasts(written["prefix"], "center")
    found = plan_of(pairs)
    assert found.count("\nLeft keys [4]: [center#") == 2 and not re.search(r"BroadcastHashJoin.*\nLeft keys \[4\]: \[center#", found)


def test_lines_in_turns_and_tables_that_go(spark, monkeypatch):
    draw = random.Random(9)
    firsts = [words(draw, 9, 7) for _ in range(60)]
    docs = table(spark, ["\n".join([t, draw.choice(firsts), t[:-1] + "#"]) for t in firsts] + [None, "x", firsts[0]])
    at_once = rows(line_dedup.decisions(docs))
    turns = {}
    for module in (alike, line_dedup):
        monkeypatch.setattr(module, "BROADCAST_ROWS", 0)
        monkeypatch.setattr(module, "TURN_ROWS", 1)
        monkeypatch.setattr(module, "materialize_all", lambda frames, name: turns.setdefault(name, len(frames)) and materialize_all(frames, name))
    before = len(session._given_paths)
    assert rows(line_dedup.decisions(docs)) == at_once
    assert all(turns[name] == session.TURNS for name in ("banded", "bands", "inner_members", "member_texts"))
    left = {os.path.basename(p).rsplit("-", 1)[0] for p in session._given_paths[before:] if os.path.exists(p.removeprefix("file://"))}
    assert "drops" in left and not left & {"lines", "banded", "bands", "inner_members", "member_texts", "line_groups", "first", "stays"}


def test_near_copies_in_turns(spark, monkeypatch):
    draw = random.Random(10)
    made = [words(draw, 60, 6) for _ in range(30)]
    docs = table(spark, made + [t[:-1] + "#" for t in made] + ["#" + t[1:] for t in made] + made[:3] + [None])
    at_once = rows(simhash.near_dedup(docs))
    for module in (alike, simhash):
        monkeypatch.setattr(module, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(alike, "TURN_ROWS", 1)
    assert len(at_once) == len(made) + 1 and rows(simhash.near_dedup(docs)) == at_once


def test_more_pairs_than_texts_are_compared_in_turns(spark, monkeypatch):
    draw = random.Random(11)
    firsts = [words(draw, 4, 10) for _ in range(6)]
    made = [t for f in firsts for t in (f, f[:-1] + "#")]
    texts = spark.createDataFrame(list(enumerate(made)), "h1 long, norm string")
    turns = {}
    monkeypatch.setattr(alike, "materialize_all", lambda frames, name: turns.update({name: max(turns.get(name, 0), len(frames))}) or materialize_all(frames, name))
    banded = materialize(texts.selectExpr("h1", "0L AS band"), "banded")
    found = rows(alike.alike_links(banded, lambda wanted: [texts.join(wanted, "h1", "left_semi")], line_dedup.shingles, 0.8))
    assert turns["alike"] > 1
    assert {tuple(sorted(r)) for r in found if r[0] != r[1]} == {(i, i + 1) for i in range(0, len(made), 2)}


def test_tables_of_the_stages_go_when_the_next_is_written(spark, monkeypatch, tmp_path):
    spark.range(5).write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(corpus_pipeline, "STAGES", [(str(i), lambda spark, docs, sf_dir: docs.filter("id > 0")) for i in range(4)])
    before = len(session._given_paths)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 4
    stages = [p for p in session._given_paths[before:] if "/stage-" in p]
    assert [os.path.exists(p.removeprefix("file://")) for p in stages] == [False, False, True]
