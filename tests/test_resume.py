"""Runs that are lost half-way, and filling up to a target."""

import hashlib
import sys

import pytest
from conftest import rows
from pyspark import cloudpickle

from litquarry.operators import answer_store
from litquarry.plans.extraction import answer_pages
from litquarry.plans.training import fill_negatives
from litquarry.session import scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Lost(BaseException):
    """Ends the task, as a lost run does."""


def asked(log):
    return sorted(log.read_text().split("\n")[:-1]) if log.exists() else []


def note(log, prompt):
    with open(log, "a") as file:
        file.write(prompt + "\n")


def test_a_lost_run_goes_on_where_it_stopped(spark, tmp_path):
    log, store = tmp_path / "asked", scratch_path(spark, "store")
    prompts = spark.createDataFrame([(i, f"prompt {i % 40}") for i in range(80)] + [(90, None)], "id int, prompt string").coalesce(1)
    in_order = sorted(range(40), key=lambda i: hashlib.sha256(f"prompt {i}".encode()).hexdigest())
    last = f"prompt {in_order[25]}"

    def lost(prompt):
        if prompt == last:
            raise Lost
        note(log, prompt)
        return "early " + prompt

    with pytest.raises(Exception):
        answer_store.ask_missing(prompts, lost, store, per_round=10)
    saved = answer_store.stored_answers(spark, store).count()
    assert 0 < saved < 40
    first = asked(log)

    def works(prompt):
        note(log, prompt)
        return "late " + prompt

    found = answer_store.resume_answers(prompts, works, store, per_round=10).collect()
    assert len(asked(log)) - len(first) == 40 - saved  # the second run asks nothing that was saved
    assert {r["response"] for r in found if r["id"] < 80} >= {f"late {last}"}
    assert sum(r["response"].startswith("early") for r in found if r["id"] < 80) == 2 * saved
    assert [r["response"] for r in found if r["id"] == 90] == [None]

    before = len(asked(log))
    answer_store.resume_answers(prompts, works, store).collect()
    assert len(asked(log)) == before and answer_store.ask_missing(prompts, works, store) == 0


def test_failed_calls_are_repeated_by_the_next_run_only(spark, tmp_path):
    log, store = tmp_path / "asked", scratch_path(spark, "store")
    pages = spark.createDataFrame([(1, i, f"12{i} Poster Session {'BAD' if i % 3 == 0 else 'A'}") for i in range(9)], "doc_id long, page_no long, text string")

    def fails(prompt):
        note(log, prompt)
        if "BAD" in prompt:
            raise ValueError
        return "first"

    def run(fn):
        return sorted(r["response"] for r in answer_pages(pages, "[[[abstract]]]", fn, saved=store).collect())

    assert run(fails) == ["Error querying model"] * 3 + ["first"] * 6
    assert len(asked(log)) == 9
    assert run(lambda prompt: "second") == ["first"] * 6 + ["second"] * 3
    assert run(fails) == ["first"] * 6 + ["second"] * 3 and len(asked(log)) == 9


def jobs_of(spark, group, run):
    """How many Spark jobs a call starts."""
    spark.sparkContext.setJobGroup(group, group)
    try:
        run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_jobs_stay_few_and_rounds_small(spark):
    prompts = spark.range(3_000).selectExpr("id", "'prompt ' || id AS prompt")
    few, many = scratch_path(spark, "store"), scratch_path(spark, "store")
    at_10 = jobs_of(spark, "ten rounds", lambda: answer_store.ask_missing(prompts, str, few, per_round=300))
    at_100 = jobs_of(spark, "a hundred rounds", lambda: answer_store.ask_missing(prompts, str, many, per_round=30))
    assert at_100 < 2 * at_10 + 20
    found = answer_store.stored_answers(spark, many)
    assert found.count() == 3_000 and found.select("prompt_digest").distinct().count() == 3_000
    assert found.groupBy("_metadata.file_path").count().agg({"count": "max"}).first()[0] < 120  # about 30 a task


def test_no_prompts(spark):
    none = spark.createDataFrame([(1, None)], "id int, prompt string")
    store = scratch_path(spark, "store")
    assert answer_store.ask_missing(none, str, store) == 0
    assert rows(answer_store.with_answers(none, store)) == [(1, None, None)]
    assert answer_store.resume_answers(none.limit(0), str, store).collect() == []


def test_filling_up_replaces_failures_and_goes_on(spark):
    ids, store = spark.range(200), scratch_path(spark, "negatives")
    topics = spark.createDataFrame([(f"cancer {i}",) for i in range(5)], "cancer_type string")

    def write(prompt):
        if "cancer 1" in prompt or "cancer 2" in prompt:
            raise ValueError
        return prompt

    assert fill_negatives(ids, topics, write, 40, store).count() == 40
    first = {r["id"] for r in fill_negatives(ids, topics, write, 40, store).collect()}
    more = fill_negatives(ids, topics, write, 70, store).collect()
    assert len(more) == 70 and first < {r["id"] for r in more} and len({r["id"] for r in more}) == 70
    every = fill_negatives(ids, topics, write, 1_000, store).collect()  # the ids run out
    assert 70 < len(every) < 200 and not any("cancer 1" in r["abstract"] for r in every)


def test_filling_up_stops_without_progress(spark, tmp_path):
    log, store = tmp_path / "asked", scratch_path(spark, "negatives")
    topics = spark.createDataFrame([("cancer",)], "cancer_type string")

    def down(prompt):
        note(log, "x")
        raise ConnectionError

    assert fill_negatives(spark.range(1_000), topics, down, 10, store, patience=2).count() == 0
    assert len(asked(log)) == 20


def test_a_failing_replacement_leaves_the_files(spark, tmp_path):
    from litquarry.plans.training import repair_in_place
    from litquarry.sources.sinks import replace_lines

    lines = ['{"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}]}', "no json"]
    path = str(tmp_path / "chat.jsonl")

    def write(new, texts=lines):
        spark.createDataFrame([(t,) for t in texts], "value string").write.text(new)

    write(path)
    with pytest.raises(ValueError, match="1 lines"):
        replace_lines(spark, path, lambda new: write(new, lines[:1]), 2)

    def fails(new):
        write(new)
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        replace_lines(spark, path, fails, 2)
    assert sorted(r["value"] for r in spark.read.text(path).collect()) == sorted(lines)
    assert repair_in_place(spark, path) == 1 and spark.read.text(path).count() == 1
    assert [p.name for p in tmp_path.iterdir() if p.name.startswith("chat")] == ["chat.jsonl"]
