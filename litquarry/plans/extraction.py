"""From page texts to parsed extractions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from litquarry.functions.text import SESSION_HEADER, render_prompt
from litquarry.operators.answer_store import resume_answers
from litquarry.operators.extraction import extract_batch, parse_responses, rejected_responses, split_at_headers
from litquarry.session import materialize


def answer_pages(
    pages: DataFrame, template: str, fn: Callable[[str], str], text: str = "text", header: str = SESSION_HEADER,
    across_pages: bool = False, saved: str | None = None,
) -> DataFrame:
    """Abstracts of the pages with the caller's answer to their prompt, as a written table.

    Each prompt is asked once, whatever is done with the result. ``saved`` names an append-only
    table of answers that outlives the run: prompts it has are not asked again, so a lost run
    goes on where it stopped, and failed calls are repeated by the next run.
    """
    abstracts = split_at_headers(pages, text, header, across_pages=across_pages)
    prompted = abstracts.withColumn("prompt", render_prompt(template, "Abstract"))
    answers = extract_batch(prompted, fn) if saved is None else resume_answers(prompted, fn, saved)
    return materialize(answers.drop("prompt"), "answers")


def extract_and_reject(answers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The written answers that are JSON objects, parsed, and the others as they came."""
    return parse_responses(answers), rejected_responses(answers)


def extract_from_pages(
    pages: DataFrame, template: str, fn: Callable[[str], str], text: str = "text", header: str = SESSION_HEADER,
    across_pages: bool = False, saved: str | None = None,
) -> DataFrame:
    """The answers that are JSON objects, with the abstract they belong to."""
    return extract_and_reject(answer_pages(pages, template, fn, text, header, across_pages, saved))[0]
