"""Language identification by cross-parsing against suffix automata."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from litquarry.llm.common import documents, fold, free_prefix, text_or_empty, worker_model
from litquarry.llm.registry import query
from litquarry.llm.texts import code_points, parts

REFERENCE_CHARS = 24_000
"""Lower-cased letters and spaces of labelled text per language that an automaton is built from."""
SAMPLE_DOCS = 400
"""Labelled documents per language these are taken from, chosen by a hash of their id."""
GROUP_CELLS = 100_000_000
"""Cells of the tables held at once, four bytes each: more languages than fit are parsed in groups."""
DENSE_CELLS = 50_000_000
"""Cells of one language's table; a language with more, by its many letters, keeps its transitions sorted instead."""
BLOCK = 512
"""Characters parsed on their own: a phrase ends at the end of a block."""
BATCH_BLOCKS = 4_096
SALTS = (256, 16, 1)
"""Parts of a language in which the sample is drawn, each time from the samples of the parts before."""
UNKNOWN = "und"

Reference = tuple[tuple[str, str], ...]
Machine = tuple[int, np.ndarray, np.ndarray, np.ndarray]
"""States of an automaton, and of each transition the state, the character's code point and the next state."""
_OTHER = regex.compile(r"\P{L}+")


def letters(text: str) -> str:
    """Lower-cased letters, with one space for each run of anything else."""
    return _OTHER.sub(" ", text.lower()).strip()


def transitions(machine: Machine) -> int:
    """Cells of a machine's table over its own letters, or of its sorted transitions where that is smaller or must be."""
    states, _, chars, _ = machine
    cells = states * (len(np.unique(chars)) + 1)
    return cells if cells <= DENSE_CELLS else 3 * len(chars)


class Table:
    """The transitions of one suffix automaton over its own letters; ``letters`` are their code points in order.

    A state is reached by the factors of the reference that end there, so walking from the root,
    state 0, as long as there is a transition finds the longest match. Letter 0 has none.
    """

    def __init__(self, machine: Machine):
        states, start, chars, end = machine
        self.letters = np.unique(chars)
        self.width = len(self.letters) + 1
        keys = start.astype(np.int64) * self.width + np.searchsorted(self.letters, chars) + 1
        self.root = np.full(self.width, -1, np.int32)
        self.root[keys[start == 0]] = end[start == 0]
        self.keys = None
        if states * self.width <= DENSE_CELLS:
            self.ends = np.full(states * self.width, -1, np.int32)
            self.ends[keys] = end
        else:
            order = np.argsort(keys)
            self.keys, self.ends = np.append(keys[order], -1), np.append(end[order], np.int32(-1))

    def step(self, states: np.ndarray, letters: np.ndarray) -> np.ndarray:
        """The next states, -1 where there is none."""
        wanted = states * self.width + letters
        if self.keys is None:
            return self.ends[wanted]
        at = np.searchsorted(self.keys[:-1], wanted)
        return np.where(self.keys[at] == wanted, self.ends[at], np.int32(-1))


class Automata:
    """Suffix automata of several reference texts, and one numbering of all their letters.

    A text is numbered once, by ``codes``; each language translates the numbers to its own letters,
    so its table is as wide as its own alphabet and does not grow with the other languages'.
    """

    def __init__(self, reference: Reference, machines: list[Machine] | None = None):
        machines = machines or [suffix_automaton([ord(c) for c in text]) for _, text in reference]
        self.languages = [name for name, _ in reference]
        self.tables = [Table(m) for m in machines]
        alphabet = np.unique(np.concatenate([table.letters for table in self.tables]))
        self.codes = np.zeros(0x110000, np.uint32 if len(alphabet) > 0xFFFF else np.uint16)
        self.codes[alphabet] = np.arange(1, len(alphabet) + 1)
        self.own = []
        for table in self.tables:
            own = np.zeros(len(alphabet) + 1, np.int32)
            own[self.codes[table.letters]] = np.arange(1, table.width)
            self.own.append(own)

    def phrases(self, blocks: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Phrases of the greedy parse of each block, a row, by each language, a column.

        All blocks advance by one character together; where a match ends, a phrase is counted and
        the character starts the next one at the root. A character that the reference lacks is a
        phrase of its own.
        """
        order = np.argsort(-lengths, kind="stable")
        blocks, lengths = np.ascontiguousarray(blocks[order].T), lengths[order]
        active = np.searchsorted(-lengths, -np.arange(blocks.shape[0]), side="left")
        out = np.zeros((len(self.tables), len(lengths)), np.int32)
        for table, own, count in zip(self.tables, self.own, out):
            state = np.zeros(len(lengths), np.int64)
            for t in range(blocks.shape[0]):
                n = active[t]
                if not n:
                    break
                c = own[blocks[t, :n]]
                at = table.step(state[:n], c)
                ended = np.flatnonzero(at < 0)
                again = table.root[c[ended]]
                unread = again < 0
                count[ended] += (state[ended] != 0) + unread.astype(np.int32)
                at[ended] = np.where(unread, 0, again)
                state[:n] = at
            count += state != 0
        found = np.empty((len(lengths), len(self.tables)), np.int32)
        found[order] = out.T
        return found


class Languages:
    """The automata of all languages; iterated, the tables of one group of languages after another.

    A character that no reference of a group has is one that each of them lacks, so a language's
    phrases do not depend on its group.
    """

    def __init__(self, reference: Reference, cells: int = GROUP_CELLS):
        self.languages = [name for name, _ in reference]
        self.groups: list[list[tuple[tuple[str, str], Machine]]] = []
        held = 0
        for name, text in reference:
            machine = suffix_automaton([ord(c) for c in text])
            size = transitions(machine)
            if not self.groups or held + size > cells:
                self.groups.append([])
                held = 0
            held += size
            self.groups[-1].append(((name, text), machine))
        self.only = self._table(self.groups[0]) if len(self.groups) == 1 else None

    def _table(self, group: list[tuple[tuple[str, str], Machine]]) -> Automata:
        return Automata(tuple(r for r, _ in group), [m for _, m in group])

    def __iter__(self) -> Iterator[Automata]:
        for group in self.groups:
            yield self.only or self._table(group)


def suffix_automaton(text: list[int]) -> Machine:
    """The smallest automaton that reads the factors of ``text``."""
    link, longest = [-1], [0]
    step: list[dict[int, int]] = [{}]
    last = 0
    for c in text:
        new = len(step)
        step.append({})
        longest.append(longest[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if longest[q] == longest[p] + 1:
                link[new] = q
            else:
                clone = len(step)
                step.append(dict(step[q]))
                longest.append(longest[p] + 1)
                link.append(link[q])
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = clone
                    p = link[p]
                link[q] = link[new] = clone
        last = new
    start = np.repeat(np.arange(len(step), dtype=np.int32), [len(edges) for edges in step])
    chars = np.fromiter((c for edges in step for c in edges), np.int32, len(start))
    return len(step), start, chars, np.fromiter((s for edges in step for s in edges.values()), np.int32, len(start))


def automata(reference: Reference) -> Languages:
    return worker_model(("automata", reference), lambda: Languages(reference))


def learn(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, chars: int = REFERENCE_CHARS) -> Reference:
    """(language, reference text) of every label of the rows of ``docs``, the most frequent language first.

    The reference is a bounded sample: the first ``chars`` letters of at most ``sample_docs``
    documents per language, in the order of a hash of the id, each giving an equal share or less.
    Rows without a language or without a letter in their text teach nothing; a text's share begins
    at its first letter, so every label with a letter in any of its texts is learned.
    """
    labelled = docs.filter(F.col("text").rlike("\\p{L}") & F.col("lang").isNotNull())
    order = [F.xxhash64("doc_id"), "doc_id", "text"]
    share = -(-chars // sample_docs) * 8
    sample = labelled.select("doc_id", "lang", _from_first_letter(share).alias("text"))
    for salts in SALTS:
        part = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(salts))
        place = F.row_number().over(Window.partitionBy("lang", part).orderBy(*order))
        sample = sample.withColumn("place", place).filter(F.col("place") <= sample_docs)
    rows = sample.join(labelled.groupBy("lang").count(), "lang").select("count", "lang", "place", "text").collect()
    texts: dict[str, str] = {}
    for _, lang, _, text in sorted(rows, key=lambda r: (-r["count"], r["lang"], r["place"])):
        have = texts.get(lang, "")
        if len(have) < chars:
            texts[lang] = (have + " " + letters(text))[:chars]
    return tuple(texts.items())


def _from_first_letter(size: int) -> Column:
    return F.substring(F.regexp_replace("text", "^\\P{L}+", ""), 1, size)


def scores(texts: list[str], model: Languages) -> tuple[list[str], list[float]]:
    """Language and score of each text: the fewest phrases win, ties go to the more frequent language."""
    joined = [letters(t) for t in texts]
    owner, lengths = [], []
    for i, text in enumerate(joined):
        for low in range(0, len(text), BLOCK):
            owner.append(i)
            lengths.append(min(BLOCK, len(text) - low))
    total = np.zeros((len(texts), len(model.languages)), np.int64)
    points = code_points("".join(joined))
    owners, sizes = np.asarray(owner, np.int64), np.asarray(lengths, np.int64)
    ends = np.cumsum(sizes)
    first = 0
    for table in model:
        codes, counts = table.codes[points], total[:, first:first + len(table.languages)]
        for low in range(0, len(owners), BATCH_BLOCKS):
            part = sizes[low:low + BATCH_BLOCKS]
            grid = np.zeros((len(part), BLOCK), codes.dtype)
            inside = np.arange(BLOCK) < part[:, None]
            grid[inside] = codes[(ends[low] - part[0]):ends[low + len(part) - 1]]
            np.add.at(counts, owners[low:low + len(part)], table.phrases(grid, part))
        first += len(table.languages)
    names, values = [], []
    for text, phrases in zip(joined, total.tolist()):
        if not text or not phrases:
            names.append(UNKNOWN)
            values.append(0.0)
            continue
        best = min(range(len(phrases)), key=phrases.__getitem__)
        rest = sum(phrases) - phrases[best]
        names.append(model.languages[best])
        values.append(1.0 - phrases[best] * (len(phrases) - 1) / rest if rest else 1.0)
    return names, values


RESULT = "lang_pred string, score double"


def with_language(docs: DataFrame, reference: Reference, name: str) -> DataFrame:
    """The documents with a new struct column of the predicted language and its score."""

    @F.pandas_udf(RESULT)
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = automata(reference) if reference else None
        for texts in batches:
            names, values = [], []
            for part in parts(texts.tolist()):
                found = scores(part, model) if model else ([UNKNOWN] * len(part), [0.0] * len(part))
                names += found[0]
                values += found[1]
            yield pd.DataFrame({"lang_pred": names, "score": values})

    return docs.withColumn(name, predict(text_or_empty()))


def learned_rows(docs: DataFrame) -> DataFrame:
    """The rows a language may be learned from."""
    return docs.filter(fold("doc_id", 4) != 2)


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row.

    The whole text is read as lower-cased letters and single spaces, in blocks that are parsed on
    their own. Each language's phrases are counted over all blocks; all languages parse the same
    characters, so the counts need no further normalisation to be compared. The score is one less
    the best count over the mean of the others: 0 where the best is no better, near 1 where it
    needs far fewer phrases. A null text, or one without a letter, is ``und`` with score 0, and so is every
    text if no row is labelled. Repeated rows and null ids are predicted like others. An empty
    table gives an empty result; lang, source and doc_id take no part in a prediction.
    """
    reference = learn(learned_rows(docs))
    found = with_language(docs.select("doc_id", "text"), reference, "found")
    return found.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "found.lang_pred", "found.score")


def keep_identified(docs: DataFrame) -> DataFrame:
    """The documents whose language can be told: those without any letter go. All columns are kept."""
    name = free_prefix(docs.columns) + "language"
    found = with_language(docs, learn(learned_rows(docs)), name)
    return found.filter(F.col(name)["lang_pred"] != UNKNOWN).drop(name)


@query()
def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(documents(spark, sf_dir))
