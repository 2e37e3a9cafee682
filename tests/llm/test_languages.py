"""Languages beyond one table."""

import random

import numpy as np

from litquarry.llm import language


def test_every_label_is_learned_and_predicted(spark):
    draw = random.Random(4)
    made = {f"l{k:02}": [chr(0x4E00 + 10 * k + i) for i in range(10)] for k in range(70)}
    rows = [
        (3 * i, "".join(draw.choices(alphabet, k=60)), name)
        for i, (name, alphabet) in enumerate((n, a) for n, a in made.items() for _ in range(4))
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learned = {r["lang"] for r in language.learned_rows(docs).select("lang").distinct().collect()}
    found = {r["doc_id"]: r["lang_pred"] for r in language.identify(docs).collect()}
    assert len(learned) > 64 and {n for n, _ in language.learn(language.learned_rows(docs))} == learned
    assert all(found[i] == name for i, _, name in rows if name in learned)


def test_groups_do_not_change_counts():
    draw = random.Random(5)
    reference = tuple((str(k), "".join(draw.choices("abcdefgh "[k % 4:], k=200))) for k in range(9))
    texts = ["".join(draw.choices("abcdefghz ", k=draw.randint(0, 1500))) for _ in range(30)]
    one, many = language.Languages(reference), language.Languages(reference, 5_000)
    assert len(one.groups) == 1 and len(many.groups) > 2
    assert language.scores(texts, one) == language.scores(texts, many)


def test_sorted_transitions_give_the_same_counts(monkeypatch):
    draw = random.Random(6)
    reference = tuple((str(k), "".join(draw.choices("abcdefgh "[k:], k=300))) for k in range(3))
    texts = ["".join(draw.choices("abcdefghz ", k=draw.randint(0, 900))) for _ in range(30)]
    dense = language.scores(texts, language.Languages(reference))
    monkeypatch.setattr(language, "DENSE_CELLS", 0)
    model = language.Languages(reference)
    assert all(table.keys is not None for table in model.only.tables)
    assert language.scores(texts, model) == dense


def test_blocks_add_at_most_a_phrase_for_each_end():
    draw = random.Random(7)
    reference = (("a", "".join(draw.choices("abc ", k=400))), ("b", "".join(draw.choices("abd ", k=400))))
    model = language.Automata(reference)
    for _ in range(20):
        text = "".join(draw.choices("abcd ", k=draw.randint(1, 3000)))
        codes = model.codes[language.code_points(text)]
        whole = model.phrases(codes[None], np.array([len(text)]))[0]
        cut = [codes[low:low + language.BLOCK] for low in range(0, len(text), language.BLOCK)]
        found = sum(model.phrases(part[None], np.array([len(part)]))[0] for part in cut)
        assert ((whole <= found) & (found <= whole + len(cut) - 1)).all()


def test_a_letter_behind_other_characters_is_learned(spark):
    rows = [(3, "123 " * 200 + "été là", "fr"), (4, "... 42", "none"), (6, "the thing", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert dict(language.learn(docs)) == {"fr": " été là", "en": " the thing"}
