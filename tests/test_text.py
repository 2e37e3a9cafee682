import json
import random
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from litquarry.functions import answers, text
from litquarry.functions.templates import EXTRACTION_PROMPT
from litquarry.operators import extraction


def random_texts(seed, pieces, n=300):
    rng = random.Random(seed)
    return ["".join(rng.choice(pieces) for _ in range(rng.randrange(14))) for _ in range(n)]


def one_column(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")


def applied(spark, values, fn):
    return [r[1] for r in sorted(one_column(spark, values).select("i", fn("v")).collect())]


def expected_clean(value):
    first = (value or "").split(",")[0].strip()
    return re.sub(r"[^a-zA-Z0-9\s]", "", re.sub(r"\([^)]*\)", "", first)).lower().strip()


def test_clean_indication(spark):
    pieces = ["Lung", "(", ")", ",", "-", " ", " ", "\t", "\n", "Ca", "é", "12", "\x1c", ";", "(x, y)"]
    values = [None, "", "---", "Breast (a, b) Cancer", "Non-Small Cell", "A (b) c, d"] + random_texts(1, pieces)
    assert applied(spark, values, text.clean_indication) == [expected_clean(v) for v in values]


def test_abstract_number(spark):
    values = ["1234 Poster", "x12", "", "٣٤ a", "7", None]
    assert applied(spark, values, text.abstract_number) == ["1234", None, None, "٣٤", "7", None]


def test_strip_equals_python(spark):
    values = random_texts(2, [" ", "\t", " ", "　", "\x1f", "\x85", "a", "b c", "\n"])
    assert applied(spark, values, text.strip) == [v.strip() for v in values]


def expected_pieces(value):
    pattern = r"\d{3,}\s+(Poster Session|Oral Abstract Session|Rapid Oral Abstract Session|Clinical Science Symposium)"
    starts = [m.start() for m in re.finditer(pattern, value)]
    return [value[a:b].strip() for a, b in zip(starts, starts[1:] + [len(value)])]


def test_header_pieces(spark):
    pieces = [
        "12345 Poster Session", "77", "100", " ", "\n", "Poster Session", "9999 Oral Abstract Session",
        "123\n\tRapid Oral Abstract Session", "555 Clinical Science Symposium", "some text. ", "\u0001", "٣٣٣",
    ]
    values = ["", "no header", "12 Poster Session", "lead 12345 Poster Session body"] + random_texts(3, pieces)
    found = applied(spark, values, text.header_pieces)
    assert found == [expected_pieces(v) for v in values]
    assert sum(len(p) > 1 for p in found) > 20


def test_long_text_splits_without_overflow(spark):
    body = "word " * 200_000
    value = f"111 Poster Session {body}222 Poster Session {body}"
    assert [len(p) for p in applied(spark, [value], text.header_pieces)[0]] == [len(body) + 18, len(body) + 18]


def test_render_prompt_is_literal(spark):
    values = ["plain", "$1 \\1", "[[[abstract]]] again", "é\n\"q\""]
    assert applied(spark, values, lambda c: text.render_prompt(EXTRACTION_PROMPT, c)) == [
        EXTRACTION_PROMPT.replace("[[[abstract]]]", v) for v in values
    ]


def test_missing_values(spark):
    assert applied(spark, ["n/a", "N/A", None, "x"], text.na_to_null) == [None, "N/A", None, "x"]
    assert applied(spark, ["n/a", None, "x"], text.null_to_na) == ["n/a", "n/a", "x"]


def test_join_sections(spark):
    df = spark.createDataFrame([(["a", "b"],), (["a", None],), ([],), (None,)], "s array<string>")
    assert [r[0] for r in df.select(text.join_sections("s")).collect()] == ["a b", "a ", "", "No abstract available"]


JSON_TEXTS = [
    "", "a", "é", "\U0001f600x", "q\"\\\n\r\t\b\f", "\x00\x07\x0b\x1f\x7f ", "\\u000B é",
    "".join(chr(i) for i in range(1, 400)), "".join(chr(0x4E00 + i) for i in range(200)), None,
]


def lower_hex(text):
    return re.sub(r"\\u([0-9A-F]{4})", lambda m: m[0].lower(), text.replace("\\\\", "\0")).replace("\0", "\\\\")


def test_json_text_equals_python(spark):
    """Byte for byte, but for the case of hex digits."""
    assert list(map(lower_hex, applied(spark, JSON_TEXTS, answers.json_text))) == [json.dumps(v) for v in JSON_TEXTS]
    got = applied(spark, JSON_TEXTS, lambda c: answers.encode_answer(c, F.lit("B, C")))
    assert list(map(lower_hex, got)) == [json.dumps({"Disease": v, "Genes": "B, C"}) for v in JSON_TEXTS]


def test_chat_line_equals_python(spark):
    df = spark.createDataFrame(
        [(i, [("user", t or ""), ("assistant", "ü")]) for i, t in enumerate(JSON_TEXTS)],
        "i int, messages array<struct<role string, content string>>",
    )
    for i, line in df.select("i", answers.chat_line(df)).collect():
        sample = {"messages": [{"role": "user", "content": JSON_TEXTS[i] or ""}, {"role": "assistant", "content": "ü"}]}
        assert lower_hex(line) == json.dumps(sample)


RESPONSES = [
    '{"Disease":"x","Genes":"A"}', '{"a":1} x', '{"a":1}]', '{"a":1},{"b":2}', '{"a":1}}', "{'a':1}", '{"a":NaN}',
    '{"a":1,"a":2}', "[1]", "3", "null", "", '  {"a":"b"} \n', '{"a":01}', '{"a":"\\x"}', '{"a":"b\nc"}', "{a:1}",
    '{"a":1,}', '{"a":Infinity}', '{"a": 1} // c', "{}", '{"Disease": "x", "Genes": {"k":[1]}}', '{"a":+1}',
    '{"a":.5}', '{"a":1.}', '{"a":tru}', '{"a"', "Error querying model", '"text"', "true", '{"a":-Infinity}', None,
    '{"Genes":"A","Genes":["B"]}', '{"Disease":"x","z":{"a":1,"a":2},"Genes":"n"}',
    '{"a":{"b":{"c":[]}}}', '{"a":1}{"b":2}', '[{"a":1}]', '{"Disease": null, "Genes": []}', "{}{}", "{},{}",
]


def is_object(value):
    try:
        return isinstance(json.loads(value), dict)
    except (ValueError, TypeError):
        return False


def test_strict_object_accepts_what_python_accepts(spark):
    got = applied(spark, RESPONSES, lambda c: answers.strict_object(c).isNotNull())
    assert got == [is_object(v) for v in RESPONSES]


def test_accepted_and_rejected_responses_add_up(spark):
    df = spark.createDataFrame([(str(i), r) for i, r in enumerate(RESPONSES)], "Abstract string, response string")
    accepted = extraction.parse_responses(df)
    rejected = extraction.rejected_responses(df)
    assert accepted.count() + rejected.count() == len(RESPONSES)
    found = {r["abstract"]: (r["Disease"], r["Genes"]) for r in accepted.withColumn("Genes", F.to_json("Genes")).collect()}
    assert found["0"] == ("x", '"A"')
    assert found["21"] == ("x", '{"k":[1]}')
    assert found[str(RESPONSES.index('{"Disease": null, "Genes": []}'))] == (None, "[]")
    assert found[str(RESPONSES.index('{"Genes":"A","Genes":["B"]}'))] == (None, '["B"]')
    assert found[str(RESPONSES.index('{"Disease":"x","z":{"a":1,"a":2},"Genes":"n"}'))] == ("x", '"n"')


@pytest.mark.parametrize(
    "genes, expected",
    [
        ('"n/a"', [None]), ('"A, B"', ["A", "B"]), ('"A,,B"', ["A", None, "B"]), ('""', [None]),
        ('["A","B "]', ["A", "B"]), ('["n/a"]', ["n/a"]), ("[]", []), ("17", [None]), ("null", [None]),
        ('{"k":1}', [None]), ('["",null," "]', [None, None, ""]), ('"n/a, TP53"', ["n/a", "TP53"]), ("true", [None]),
        (None, [None]),
    ],
)
def test_gene_shapes(spark, genes, expected):
    df = spark.createDataFrame([("123 a", "n/a", genes)], "abstract string, Disease string, g string")
    got = extraction.explode_genes(df.withColumn("Genes", F.parse_json("g")))
    assert [tuple(r) for r in got.collect()] == [("123", "123 a", None, g) for g in expected]


def test_failed_answers_keep_their_row(spark):
    df = spark.createDataFrame([(1, "ok"), (2, "bad"), (None, None)], "id bigint, prompt string")

    def fn(prompt):
        if prompt != "ok":
            raise RuntimeError("no")
        return "fine"

    assert rows(extraction.extract_batch(df, fn)) == [
        (1, "ok", "fine"), (2, "bad", "Error querying model"), (None, None, "Error querying model"),
    ]


def test_headers_cut_by_page_ends(spark):
    """Random pages of a document against the pieces of its joined text."""
    import random
    import re

    from litquarry.operators.extraction import pieces_across_pages

    draw = random.Random(1)
    header = r"\d{3,}\s+(?:Poster|Oral) Session"
    pages, expected = [], {}
    for doc in range(60):
        bits = ["123 Poster Session", "4567  Oral Session", " a ", "12 Poster", "Session", "x\n", "é", "99", "  ", "￿"]
        whole = "".join(draw.choice(bits[:9 if doc % 5 else 10]) for _ in range(draw.randint(0, 25)))
        between = "\n" if doc % 2 else ""
        cut, at = [], 0
        while at < len(whole) or not cut:
            size = draw.choice([0, 1, 3, 8, 30])
            cut.append(whole[at:at + size])
            at += size
        pages += [(between, doc, None if i == 0 else i, t if t or draw.random() < 0.5 else None) for i, t in enumerate(cut)]
        joined = between.join(cut)
        starts = [m.start() for m in re.finditer(header, joined)] + [len(joined)]
        expected |= {(doc, i): joined[a:b].strip() for i, (a, b) in enumerate(zip(starts, starts[1:]))}
    found = {}
    for between in ("", "\n"):
        part = spark.createDataFrame([p[1:] for p in pages if p[0] == between], "doc_id long, page_no long, text string").repartition(3)
        found |= {(r["doc_id"], r["piece_no"]): r["Abstract"] for r in pieces_across_pages(part, header=header, between=between, header_chars=40).collect()}
    assert found == expected


def test_repeated_and_unnumbered_pages(spark):
    from litquarry.operators.extraction import split_at_headers

    pages = [("d", 0, "1234 Poster Session a"), ("d", 1, "more a"), ("d", 1, "more a"), ("d", None, "intro 111 Poster Session first"), (None, None, "222 Poster Session n")]
    df = spark.createDataFrame(pages, "doc_id string, page_no long, text string").repartition(3)
    assert sorted(map(tuple, split_at_headers(df, across_pages=True).collect()), key=repr) == sorted([
        ("d", 0, "111 Poster Session first"), ("d", 1, "1234 Poster Session a\nmore a\nmore a"), (None, 0, "222 Poster Session n"),
    ], key=repr)
    assert split_at_headers(df.limit(0), across_pages=True).collect() == []


def test_short_pages_are_put_together(spark, monkeypatch):
    """Sheets of any size give the pieces of the joined text, beside long pages and empty ones."""
    import random
    import re

    from litquarry.operators import extraction

    draw = random.Random(2)
    header = r"\d{3,}\s+(?:Poster|Oral) Session"
    pages, expected = [], {}
    for doc in range(40):
        bits = ["123 Poster Session", "4567  Oral Session", " a ", "12 Poster", "Session", "x\n", "é", "99", "  "]
        whole = "".join(draw.choice(bits) for _ in range(draw.randint(0, 90)))
        cut, at = [], 0
        while at < len(whole) or not cut:
            size = draw.choice([0, 1, 3, 8, 30, 150])
            cut.append(whole[at:at + size])
            at += size
        pages += [(doc, i, t) for i, t in enumerate(cut)]
        starts = [m.start() for m in re.finditer(header, whole)] + [len(whole)]
        expected |= {(doc, i): whole[a:b].strip() for i, (a, b) in enumerate(zip(starts, starts[1:]))}
    df = spark.createDataFrame(pages, "doc_id long, page_no long, text string").repartition(3)
    written = {}

    def kept(table, name, write=extraction.materialize):
        written[name] = write(table, name)
        return written[name]

    monkeypatch.setattr(extraction, "materialize", kept)
    for chars in (16, 1 << 15):
        monkeypatch.setattr(extraction, "SHEET_CHARS", chars, raising=False)
        found = extraction.pieces_across_pages(df, header=header, between="", header_chars=40).collect()
        assert {(r["doc_id"], r["piece_no"]): r["Abstract"] for r in found} == expected
    long_pages = sum(len(t) > 120 for _, _, t in pages)
    assert written["page_joints"].count() <= 40 + 2 * long_pages < len(pages) / 2
