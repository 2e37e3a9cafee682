"""Every operator against a plain version of its rule."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest

from litquarry.llm import (
    exact_dedup, language, line_dedup, packing, quality_classifier, quality_rules, registry, secrets, sentencepieces, sharding, simhash,
)
from litquarry.llm.common import documents
from litquarry.llm.components import components
from litquarry.llm.crf import Crf, fit

SMALL = "/root/testdata/sf0.001"
MIDDLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] or "" for r in documents(spark, SMALL).collect()}


def test_every_operator_is_registered():
    assert {re.match(r"op\d+_", q)[0] for q in registry.queries} == {f"op{n}_" for n in range(1, 14)}


# sharding

def test_differencing_is_known_on_a_small_case():
    parts = sharding.differencing([8, 7, 6, 5, 4], 2)
    sums = [sum(s for s, p in zip([8, 7, 6, 5, 4], parts) if p == k) for k in (0, 1)]
    assert sorted(sums) == [14, 16]


@pytest.mark.parametrize("n, parts", [(0, 3), (1, 3), (2, 5), (300, 24)])
def test_differencing_balances(n, parts):
    draw = random.Random(n)
    sizes = [draw.randint(1, 10_000) for _ in range(n)]
    found = sharding.differencing(sizes, parts)
    sums = np.bincount(found, weights=sizes, minlength=parts) if n else np.zeros(parts)
    assert len(found) == n and (n < 100 or sums.max() - sums.min() < 0.01 * sums.mean())


@pytest.mark.parametrize("last", [40_000, 150])
def test_shards(spark, monkeypatch, last):
    monkeypatch.setattr(sharding, "LAST_ITEMS", last)
    monkeypatch.setattr(sharding, "SLOT_CELL", 4)
    docs = documents(spark, MIDDLE)
    rows = sharding.byte_shards(docs).collect()
    by_text = collections.defaultdict(set)
    text_of = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    sums, slots = collections.Counter(), collections.defaultdict(list)
    for r in rows:
        raw = text_of[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 8, zlib.crc32(raw), "bytes", None)
        by_text[raw].add(r["shard"])
        sums[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(len(s) == 1 for s in by_text.values()) and set(sums) == set(range(24))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(sums.values()) - min(sums.values()) < (100 if last > 1000 else 0.02 * sums[0])


# SimHash and components

def plain_fingerprint(text, words=3):
    import xxhash

    found = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    if not found:
        return 0
    shingles = [" ".join(found[i:i + words]) for i in range(max(1, len(found) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", ["", " \n", "One", "ONE two", "one two three", "É É é  a b c\x1cd e", "a b c " * 50])
def test_fingerprint(text):
    assert simhash.fingerprint(text) % (1 << 64) == plain_fingerprint(text)


def plain_components(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def test_links_are_all_pairs_within_three_bits(spark):
    draw = random.Random(5)
    prints = set()
    for _ in range(12):
        base = draw.getrandbits(64)
        for _ in range(40):
            value = base
            for _ in range(draw.randint(0, 4)):
                value ^= 1 << draw.randrange(64)
            prints.add(value)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    expected = {tuple(sorted(p)) for p in itertools.combinations(signed, 2) if bin((p[0] ^ p[1]) % (1 << 64)).count("1") <= 3}
    found = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long")).collect()
    assert {(r["a"], r["b"]) for r in found} == expected and len(found) == len(expected)


def test_components(spark):
    draw = random.Random(1)
    links = [(i, i + 1) for i in range(100, 160)] + [(draw.randrange(60), draw.randrange(60)) for _ in range(40)] + [(7, 7)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    expected = plain_components({n for link in links for n in link if link[0] != link[1]}, [x for x in links if x[0] != x[1]])
    assert found == expected


def test_simhash_query(spark, texts):
    rows = {r["doc_id"]: r for r in registry.queries["op2_simhash_components"](spark, SMALL).collect()}
    prints = {i: plain_fingerprint(t) for i, t in texts.items()}
    near = [(a, b) for a, b in itertools.combinations(sorted(prints), 2) if bin(prints[a] ^ prints[b]).count("1") <= 3]
    root = plain_components(sorted(prints), near)
    assert {i: (r["fingerprint"], r["component_id"]) for i, r in rows.items()} == {i: (f"{p:016x}", root[i]) for i, p in prints.items()}


# conditional random field, rules and secrets

def path_score(field, scores, path):
    return field.first[path[0]] + sum(s[y] for s, y in zip(scores, path)) + sum(field.step[a, b] for a, b in zip(path, path[1:]))


def test_decoding_is_the_best_path():
    draw = np.random.default_rng(0)
    for _ in range(30):
        field = Crf(draw.normal(size=(2, 3)), draw.normal(size=(3, 3)), draw.normal(size=3))
        scores = draw.normal(size=(5, 3)) * 2
        best = max(itertools.product(range(3), repeat=5), key=lambda p: path_score(field, scores, p))
        assert field.decode(scores.tolist()) == list(best)


def test_certain_positions_keep_their_label_in_any_chain():
    draw = np.random.default_rng(1)
    tried = 0
    for _ in range(300):
        field = Crf(np.eye(3), draw.normal(size=(3, 3)), draw.normal(size=3))
        sure = np.array([draw.uniform(0, 8), 0.0, 0.0])
        if not field.certain(sure, 0):
            continue
        tried += 1
        scores = np.concatenate([draw.normal(size=(3, 3)) * 3, sure[None], draw.normal(size=(3, 3)) * 3])
        at = int(draw.integers(0, 7))
        scores[[3, at]] = scores[[at, 3]]
        assert field.decode(scores.tolist())[at] == 0
    assert tried > 20


def test_fitting_reaches_the_best_likelihood():
    draw = np.random.default_rng(2)
    chains = []
    for _ in range(30):
        y = np.repeat(draw.integers(0, 2, 4), draw.integers(1, 5, 4))
        chains.append((np.stack([np.ones(len(y)), (y + (draw.random(len(y)) < 0.2)) % 2], axis=1), y))

    def likelihood(field):
        total = 0.0
        for x, y in chains:
            scores = field.scores(x)
            ahead = field.first + scores[0]
            for row in scores[1:]:
                ahead = np.log(np.exp(ahead[:, None] + field.step).sum(0)) + row
            total += path_score(field, scores, y.tolist()) - np.log(np.exp(ahead).sum())
        return total

    field = fit(chains, 2, rounds=400, ridge=0.0)
    best = likelihood(field)
    for name, shape in (("emit", (2, 2)), ("step", (2, 2)), ("first", (2,))):
        for _ in range(10):
            moved = {k: getattr(field, k) for k in ("emit", "step", "first")}
            moved[name] = moved[name] + draw.normal(0, 0.2, shape)
            assert likelihood(Crf(**moved)) < best


def plain_measures(text):
    words = re.findall(r"[^\x20\x09-\x0d]+", text)
    lines = text.split("\n")
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    count = collections.Counter(windows)
    inside = {j for i, w in enumerate(windows) if count[w] > 1 for j in range(i, i + 5)}
    dups = sum(bool(re.search(r"[^\x20\x09-\x0d]", x)) and x in lines[:i] for i, x in enumerate(lines))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dups, len(inside)


def test_base_measures(texts):
    draw = random.Random(3)
    made = ["".join(draw.choice(["a ", "b ", "é\n", "\n", "#", " \x1c", "\x0b"]) for _ in range(80)) for _ in range(200)]
    for text in [*texts.values(), *made, "", "\n\n"]:
        assert quality_rules.base_measures(text) == plain_measures(text)


def test_batches_do_not_change_line_features():
    made = ["", "a\n\nb #\nb #", "\n", "One LINE\nLicense 1"]
    rows, ink, counts = quality_rules.line_features(made)
    single = [quality_rules.line_features([t]) for t in made]
    assert np.array_equal(rows, np.concatenate([s[0] for s in single])) and counts.tolist() == [1, 4, 2, 2]
    assert ink.tolist() == [i for s in single for i in s[1].tolist()]


def test_rules_keep_prose_and_drop_junk(spark):
    rows = registry.queries["op3_quality_rules"](spark, MIDDLE).collect()
    quality = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{MIDDLE}/labels.parquet").collect()}
    judged = [(quality[r["doc_id"]], r) for r in rows if r["doc_id"] in quality]
    assert all(not r["kept"] for r in rows if r["base_failed"])
    good = [r["kept"] for q, r in judged if q == 1 and not r["base_failed"]]
    bad = [r["kept"] for q, r in judged if q == 0]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.05


def plain_spans(text):
    out = []
    for m in re.finditer(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text, re.I | re.A):
        out += [(m.start(), 0, m.end())] * (len(m[2]) >= 12)
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return ",".join(f"{['assign', 'access', 'hex'][k]}:{a}:{b}" for a, k, b in sorted(out))


def test_base_spans():
    draw = random.Random(4)
    bits = ["password", "API_KEY", "token", " = ", ":", "\"", "'", "AKIA", "ABCDEF0123456789", "deadbeef", "0123456789", " ", "x", "é", "=", "\n", "ſecret"]
    for _ in range(3000):
        text = "".join(draw.choice(bits) for _ in range(draw.randint(0, 25)))
        assert secrets.joined(secrets.base_spans(text)) == plain_spans(text)


@pytest.fixture(scope="module")
def field(spark):
    return secrets.train(documents(spark, MIDDLE))


def test_chains_decode_like_whole_texts(field, texts):
    made = ["a token = \"abcdef0123456789\" b c d 12 x = y", "plain words only", "1 2 3 a b c d e f 4@5", "  password :\n'Xy12345678901234' z"]
    checked = 0
    for text in [*made, *texts.values()]:
        tokens = [m.span() for m in re.finditer(r"[^\x20\x09-\x0d]+", text)][:1500]
        text = text[:tokens[-1][1]] if tokens else text
        flags = secrets.file_features(text)
        if not tokens:
            continue
        whole = dict(zip(tokens, field.decode(field.scores(secrets.features(text, tokens, flags)).tolist())))
        inside = set()
        for chain in secrets.chains(text):
            rows, shift = secrets._framed(secrets.features(text, chain, flags), text, chain)
            tags = field.decode(field.scores(rows).tolist())[shift:shift + len(chain)]
            assert [whole[t] for t in chain] == tags
            inside.update(chain)
            checked += len(chain)
        assert all(whole[t] == secrets.OUTSIDE for t in tokens if t not in inside)
    assert checked > 40


def test_field_adds_spans_and_leaves_prose_alone(field):
    assert field.certain(field.scores(secrets.PLAIN), secrets.OUTSIDE)
    added = secrets.scan("auth bearer: 7F3A9C00D1E2B4A67F3A9C00D1E2B4A6 ok", field)[1]
    assert [k for _, _, k in added] == ["crf"]
    for text in ["see http://a.example.com/page1 at 10:30 on 2024-01-02 v4.0.1", "mail a.b9@example.com, +1 (017) 555-7713, 10.0.0.12"]:
        assert secrets.scan(text, field) == ([], [])


def test_secret_query(spark, texts):
    for r in registry.queries["op4_secrets"](spark, SMALL).collect():
        plain = plain_spans(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(plain.encode()).hexdigest()
        assert set(filter(None, plain.split(","))) <= set(r["spans"].split(","))
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(plain.count(f"{k}:") for k in ("assign", "access", "hex"))


# exact dedup

def test_exact_dedup_merges_in_rounds(spark, monkeypatch):
    draw = random.Random(6)
    rows = [(i, draw.choice(["a  b", "a b", "a\tb", "c", "", None, "d" * draw.randint(1, 5)])) for i in range(400)]
    monkeypatch.setattr(exact_dedup, "shuffle_partitions", lambda spark: 40)
    found = exact_dedup.exact_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0d]+", " ", t or "")].append(i)
    expected = {
        (i, min(m), len(m), i == min(m), hashlib.sha256(t.encode()).hexdigest()) for t, m in groups.items() for i in m
    }
    assert {tuple(r) for r in found} == expected


def test_repeated_rows_keep_one(spark):
    rows = spark.createDataFrame([(1, "a")] * 5 + [(None, "b")] * 2, "doc_id long, text string").repartition(4)
    found = exact_dedup.exact_dedup(rows).collect()
    assert sorted((str(r["doc_id"]), r["group_size"], r["kept"]) for r in found) == sorted(
        [("1", 5, True)] + [("1", 5, False)] * 4 + [("None", 2, True), ("None", 2, False)]
    )


# packing

def test_encoder_equals_the_tokenizer(texts):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(packing.tokenizer_path())
    draw = random.Random(7)
    bits = list("aB'sStTl dDm1²½é É ß ñ . , !? <| |> ſ K İ 漢字 ́ 　 \x85 \x1c \t\n Σς ·×÷ª 😀 ’s\xa0") + ["<|endoftext|>", "'ll", "###"]
    made = ["".join(draw.choice(bits) for _ in range(draw.randint(0, 60))) for _ in range(2000)]
    encode = packing.Encoder(packing.tokenizer_path())
    assert encode.split
    for text in [*texts.values(), *made]:
        assert np.frombuffer(encode.encode(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(6))
def test_best_fit_and_its_bound(seed):
    draw = np.random.default_rng(seed)
    lengths = draw.integers(1, [101, 60, 40, 101, 20, 80][seed], 400) + (33 if seed == 2 else 0)
    lengths = np.minimum(lengths, 100)
    bins = packing.best_fit(lengths, 100)
    assert np.bincount(bins, weights=lengths).max() <= 100 and set(bins) == set(range(bins.max() + 1))
    bound = packing.lower_bound(lengths, 100)
    assert -(-lengths.sum() // 100) <= bound <= bins.max() + 1 <= 1.25 * bound + 1


def test_bound_beats_volume():
    assert packing.lower_bound(np.array([51] * 9), 100) == 9
    assert packing.lower_bound(np.array([34] * 9), 100) == 5


def test_packing(spark, texts, monkeypatch):
    monkeypatch.setattr(packing, "CELL_PIECES", 40)
    rows = packing.packed_documents(documents(spark, SMALL)).collect()
    encode = packing.Encoder(packing.tokenizer_path())
    got = {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in rows}
    expected = {}
    for i, t in texts.items():
        ids = encode.encode(t) + b"\0\0\0\0"
        for k, low in enumerate(range(0, len(ids), 8192)):
            part = ids[low:low + 8192]
            expected[i, k] = (low // 4, len(part) // 4, zlib.crc32(part))
    assert got == expected and len(rows) == len(expected)
    bins = collections.defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for inside in bins.values():
        end = 0
        for offset, length in sorted(inside):
            assert offset == end
            end += length
        assert end <= 2048
    bound = packing.lower_bound(np.array([r["length"] for r in rows]), 2048)
    assert len(bins) <= bound + 2


# classifier and language

def test_passages_do_not_depend_on_the_batch():
    draw = random.Random(8)
    for _ in range(100):
        made = ["".join(draw.choice("ab  \n\x1c\xa0 #!") for _ in range(draw.choice([0, 0, 3, 50, 900]))) for _ in range(4)]
        rows, counts = quality_classifier.passages(made)
        single = [quality_classifier.passages([t]) for t in made]
        assert np.allclose(rows, np.concatenate([s[0] for s in single]))
        assert counts.tolist() == [max(1, -(-len(t.encode().split()) // 100)) for t in made]


def test_classifier_slopes():
    draw = np.random.default_rng(9)
    rows, counts = draw.normal(size=(30, 4)), np.array([1, 5, 4, 10, 10])
    labels = np.array([0, 1, 1, 0, 1.0])
    model = quality_classifier.fit(rows, counts, labels)
    assert np.abs(model.score(rows, counts) - labels).max() < 0.1
    assert np.allclose(model.score(rows[1:6], np.array([5])), model.score(rows, counts)[1])


def test_classifier_on_held_out_rows(spark):
    rows = registry.queries["op7_quality_classifier"](spark, MIDDLE).collect()
    quality = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{MIDDLE}/labels.parquet").collect()}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    held = [(quality[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in quality]
    assert len(held) > 40 and np.mean([q == p for q, p in held]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)


def test_parse_is_greedy_longest_match():
    draw = random.Random(10)
    for _ in range(20):
        reference = [(str(k), "".join(draw.choice("abc ") for _ in range(draw.randint(1, 60)))) for k in range(3)]
        model = language.Automata(tuple(reference))
        blocks = ["".join(draw.choice("abcd ") for _ in range(draw.randint(1, 40))) for _ in range(5)]
        grid = np.zeros((5, 40), np.uint16)
        for row, b in zip(grid, blocks):
            row[:len(b)] = [model.codes[ord(c)] for c in b]
        found = model.phrases(grid, np.array([len(b) for b in blocks]))
        for b, counts in zip(blocks, found.tolist()):
            for (_, text), count in zip(reference, counts):
                at, phrases = 0, 0
                while at < len(b):
                    size = 1
                    while at + size < len(b) and b[at:at + size + 1] in text:
                        size += 1
                    at += size
                    phrases += 1
                assert phrases == count


def test_language_on_held_out_rows(spark):
    rows = registry.queries["op9_language"](spark, MIDDLE).collect()
    lang = {r["doc_id"]: r["lang"] for r in documents(spark, MIDDLE).collect()}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [lang[r["doc_id"]] == r["lang_pred"] for r in rows if r["held_out"]]
    assert len(held) > 200 and np.mean(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


# lines

def test_similar_lines(spark):
    rows = registry.queries["op8_line_dedup"](spark, SMALL).collect()
    docs = {r["doc_id"]: r["text"] or "" for r in documents(spark, SMALL).collect()}
    lines = collections.defaultdict(list)
    for i, t in docs.items():
        for k, line in enumerate(t.split("\n")):
            norm = re.sub(r"[ \t\n\x0b\x0c\r]{2,}|[\t\n\x0b\x0c\r]", " ", line.lower()).strip(" ")
            if len(norm) >= 20:
                lines[norm].append((i, k))
    sets = {n: {n[j:j + 5] for j in range(len(n) - 4)} for n in lines}
    near = [
        (a, b) for a, b in itertools.combinations(sorted(lines), 2)
        if 0.8 * len(sets[a]) <= len(sets[b]) <= len(sets[a]) / 0.8
        and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    ]
    groups = collections.defaultdict(list)
    for norm, root in plain_components(sorted(lines), near).items():
        groups[root] += lines[norm]
    expected = {place for places in groups.values() for place in sorted(places)[1:]}
    found = {(r["doc_id"], k) for r in rows for k in r["dropped_lines"]}
    assert found <= expected and len(found) >= 0.95 * len(expected)
    assert all(r["n_lines"] == docs[r["doc_id"]].count("\n") + 1 and r["n_dropped"] == len(r["dropped_lines"]) for r in rows)


def test_similarity_equals_python(spark):
    pairs = [("abcdefgh ijkl mnop", "abcdefgh ijkl mnoq"), ("aaaaaaaaaa", "aaaaaaa"), ("ñandú über alles gut", "ñandú über alles gut!")]
    found = line_dedup.with_similarity(spark.createDataFrame(pairs, "a string, b string"), "a", "b", "s").collect()
    for (a, b), r in zip(pairs, found):
        x, y = ({t[j:j + 5] for j in range(len(t) - 4)} for t in (a, b))
        assert r["s"] == pytest.approx(len(x & y) / len(x | y))


def test_lines_run_without_python(spark):
    import contextlib
    import io

    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        registry.queries["op8_line_dedup"](spark, SMALL).explain("formatted")
    assert not re.search("Python|Pandas|Arrow", text.getvalue())


# SentencePiece

@pytest.fixture(scope="module")
def model():
    return sentencepieces.Pieces(sentencepieces.model_path())


def test_ids_equal_the_library(model, texts):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=sentencepieces.model_path())
    draw = random.Random(11)
    bits = ["the", "ing", " ", "  ", "   ", "\n", "\t", "a", "b", "é", "ß", ".", ",", "###", "12", "3", "漢", "字", "😀", "²", "².", "▁", "de", "\0", "ſ", "'s", "x" * 5, " " * 9]
    made = ["".join(draw.choice(bits) for _ in range(draw.randint(0, 40))) for _ in range(1500)]
    every = [*texts.values(), *made, ""]
    for text, ids in zip(every, model.encode_all(every)):
        ids = np.frombuffer(ids, "<u4")
        assert ids.tolist() == library.encode(text)
        assert model.decode(ids) == library.decode(ids.tolist())
        assert "▁" in text or model.decode(ids) == text


def test_ids_and_texts_as_columns(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None), (3, "")], "doc_id long, text string")
    back = sentencepieces.with_text(sentencepieces.with_ids(docs, "ids"), "ids", "again").orderBy("doc_id").collect()
    assert [(r["again"], None if r["ids"] is None else len(r["ids"])) for r in back] == [("a b", 2), (None, None), ("", 0)]
