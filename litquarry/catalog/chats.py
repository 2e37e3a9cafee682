"""Chat samples, their repair, the training set and plans for negatives."""

from __future__ import annotations

from pyspark.sql import functions as F

from litquarry.catalog import stand_ins as s
from litquarry.catalog.registry import query
from litquarry.catalog.texts import ascii_sql, quoted
from litquarry.functions.answers import chat_line
from litquarry.functions.templates import (
    CANCER_PHRASES, EXTRACTION_PROMPT, GENERAL_PHRASES, GENERAL_TOPICS, NEGATIVE_PROMPT,
)
from litquarry.operators import chat, synthesis
from litquarry.plans.training import build_training_set, fill_negatives, negative_examples, repair_in_place
from litquarry.session import scratch_path
from litquarry.sources.sinks import write_chat_lines
from litquarry.sources.tables import read_chat_lines

PROMPT_SQL = f"replace({quoted(EXTRACTION_PROMPT)}, '[[[abstract]]]', abstract)"


def line_sql(prompt: str, disease: str, gene: str) -> str:
    answer = f"""'{{"Disease": "' || coalesce({disease}, 'n/a') || '", "Genes": "' || coalesce({gene}, 'n/a') || '"}}'"""
    return f"""'{{"messages": [{{"role": "user", "content": "' || {ascii_sql(prompt)} ||
      '"}}, {{"role": "assistant", "content": "' || {ascii_sql(answer)} || '"}}]}}'"""


@query(f"""WITH {s.LABELLED_DOCUMENTS} SELECT doc_id, {PROMPT_SQL} AS user_text,
  '{{"Disease": "' || coalesce(disease_name, 'n/a') || '", "Genes": "' || coalesce(gene, 'n/a') || '"}}'
  AS assistant_text FROM labelled WHERE abstract <> chr(32) || chr(9)""")
def build_chat(spark, folder):
    built = chat.build_chat(s.labelled_documents(spark, folder), EXTRACTION_PROMPT)
    return built.select(
        "doc_id",
        F.col("messages")[0]["content"].alias("user_text"),
        F.col("messages")[1]["content"].alias("assistant_text"),
    )


@query(f"""WITH {s.LABELLED_DOCUMENTS} SELECT doc_id, {line_sql(PROMPT_SQL, 'disease_name', 'gene')} AS line
  FROM labelled WHERE abstract <> chr(32) || chr(9)""")
def chat_lines(spark, folder):
    built = chat.build_chat(s.labelled_documents(spark, folder), EXTRACTION_PROMPT)
    return built.select("doc_id", chat_line(built).alias("line"))


@query("""WITH state AS (SELECT conv_id, max(turn) FILTER (role = 'assistant') AS last,
  bool_or(coalesce(text, '') = '') AS empty FROM conversations GROUP BY conv_id)
SELECT conv_id, turn, role, text FROM conversations JOIN state USING (conv_id) WHERE NOT empty AND turn <= last""")
def repair_turns(spark, folder):
    return chat.repair_turns(s.table(spark, folder, "conversations"))


def tool_samples(spark, folder):
    """Each document as a sample: its lines are messages, in turn a question, a call, the tool's reply and an answer.

    Some calls have broken arguments, some replies come from another tool, some lines are empty.
    """
    docs = s.table(spark, folder, "documents")
    text = lambda line: F.nullif(line, F.lit(""))

    def message(line, i):
        place = i % 4
        call = F.struct(
            F.col("lang").alias("name"),
            F.concat(
                F.lit('{"n":  '), F.length(line), F.when(F.col("source") == "src3", F.lit("")).otherwise(F.lit("}"))
            ).alias("arguments"),
        )
        return F.struct(
            F.element_at(F.array(*[F.lit(r) for r in ["user", "assistant", "function", "assistant"]]), place + 1).alias("role"),
            F.when(place == 1, F.lit("")).when(place != 2, text(line)).alias("content"),
            F.when((place == 1) | (place == 2), F.concat(F.lit("#"), line)).alias("text"),
            F.when(place == 2, F.when(F.col("source") == "src4", F.lit("other")).otherwise(F.col("lang"))).alias("name"),
            F.lit(None).cast("string").alias("tool_call_id"),
            F.when(place == 1, call).alias("function_call"),
        )

    lines = F.split("text", "\n")
    with_messages = docs.select("doc_id", F.transform(lines, message).alias("messages"))
    declared = chat.full_messages(with_messages)
    return declared.withColumn("functions", F.array(F.lit('{"name": "tool"}')))


def id_sql(place: str) -> str:
    """SQL of a generated call id."""
    digest = f"md5('123:' || doc_id || ':' || {place})"
    letters = [f"substr('{chat.CALL_ID_LETTERS}', CAST(CAST('0x' || substr({digest}, {3 * i + 1}, 3) AS BIGINT) % 62 + 1 AS BIGINT), 1)" for i in range(9)]
    return "(" + " || ".join(letters) + ")"


REPAIRED = f"""lines AS (SELECT doc_id, lang, source, unnest(string_split(text, chr(10))) AS line,
    unnest(range(len(string_split(text, chr(10))))) AS i FROM documents),
turns AS (SELECT *, i % 4 AS place, max(i) OVER (PARTITION BY doc_id) AS final FROM lines),
state AS (SELECT doc_id, max(i) FILTER (place IN (1, 3)) AS last, CASE
    WHEN bool_or((place = 1 AND source = 'src3') OR (place = 2 AND source = 'src4')) THEN 'rejected'
    WHEN bool_or(place IN (0, 3) AND line = '') OR max(i) FILTER (place IN (1, 3)) IS NULL THEN 'skipped'
    ELSE 'kept' END AS status FROM turns GROUP BY doc_id),
messages AS (SELECT doc_id, i, CASE place
    WHEN 0 THEN 'user;' || line || ';;'
    WHEN 1 THEN 'assistant;#' || line || ';;' || lang || '(' || '{{"n":  ' || length(line) || '}})' ||
      CASE WHEN i < final THEN {id_sql('(i + 1)')} ELSE '' END
    WHEN 2 THEN 'tool;#' || line || ';' || {id_sql('i')} || ';'
    ELSE 'assistant;' || line || ';;' END AS message FROM turns)"""


def flat_message(m):
    """Role, text, call id and call of a message as one text."""
    blank = F.lit("")
    call = F.get(m["tool_calls"], F.lit(0))
    called = F.concat(call["function"]["name"], F.lit("("), call["function"]["arguments"], F.lit(")"), F.coalesce(call["id"], blank))
    parts = [m["role"], F.coalesce(m["content"], m["text"]), F.coalesce(m["tool_call_id"], blank), F.coalesce(called, blank)]
    return F.concat_ws(";", *parts)


@query(f"""WITH {REPAIRED} SELECT doc_id, '{{"function": {{"name": "tool"}}}}' AS tool, status, CASE status WHEN 'kept' THEN
    (SELECT string_agg(message, chr(10) ORDER BY i) FROM messages m WHERE m.doc_id = state.doc_id AND i <= last) END AS body
FROM state""")
def repair_tool_calls(spark, folder):
    """Samples with calls and replies, repaired; the body lists role, text, call id and call of each message."""
    repaired = chat.repair_outcomes(tool_samples(spark, folder), "doc_id")
    body = F.array_join(F.transform("messages", flat_message), "\n")
    return repaired.select(
        "doc_id", F.col("tools")[0].alias("tool"), "status", F.when(F.col("status") == chat.KEPT, body).alias("body")
    )


@query(f"WITH {REPAIRED} SELECT status, count(*) AS samples FROM state GROUP BY status")
def repair_counts(spark, folder):
    """How many samples are kept, skipped and rejected."""
    outcomes = chat.repair_outcomes(tool_samples(spark, folder), "doc_id")
    return outcomes.groupBy("status").agg(F.count(F.lit(1)).alias("samples"))


@query(f"WITH {REPAIRED} SELECT status, count(*) AS samples FROM state WHERE status = 'kept' GROUP BY status")
def replaced_chat_files(spark, folder):
    """Chat files replaced by their repaired form: what is read back needs no more repair."""
    path = scratch_path(spark, "chat")
    write_chat_lines(tool_samples(spark, folder), path, "doc_id")
    repair_in_place(spark, path)
    outcomes = chat.repair_outcomes(read_chat_lines(spark, path), "raw")
    return outcomes.groupBy("status").agg(F.count(F.lit(1)).alias("samples"))


ARGUMENTS = """samples AS (SELECT event_id, event_type, CASE event_type
    WHEN 'view' THEN '{"b": 1.0, "a": [' || user_id || ', 2e5, NaN]}' WHEN 'click' THEN '{"a": 1, "a": ' || user_id || '}'
    WHEN 'purchase' THEN ' {"n": 12345678901234567890123456789012345678901234567890}' || chr(10)
    WHEN 'error' THEN '{"a": 1} ' || user_id ELSE '[' || user_id || ', "x"]' END AS arguments FROM events)"""


@query(f"""WITH {ARGUMENTS} SELECT event_id, CASE event_type WHEN 'error' THEN 'rejected' ELSE 'kept' END AS status,
  CASE WHEN event_type <> 'error' THEN trim(arguments, ' ' || chr(10)) END AS arguments FROM samples""")
def call_arguments(spark, folder):
    """Arguments of calls stay as they stand: order and repeats of keys, floats, long integers."""
    event, user = F.col("event_type"), F.col("user_id").cast("string")
    arguments = (
        F.when(event == "view", F.concat(F.lit('{"b": 1.0, "a": ['), user, F.lit(", 2e5, NaN]}")))
        .when(event == "click", F.concat(F.lit('{"a": 1, "a": '), user, F.lit("}")))
        .when(event == "purchase", F.lit(' {"n": 12345678901234567890123456789012345678901234567890}\n'))
        .when(event == "error", F.concat(F.lit('{"a": 1} '), user))
        .otherwise(F.concat(F.lit("["), user, F.lit(', "x"]')))
    )
    call = F.struct(
        F.lit("assistant").alias("role"), F.lit("calling").alias("text"),
        F.struct(F.lit("f").alias("name"), arguments.alias("arguments")).alias("function_call"),
    )
    samples = s.table(spark, folder, "events").select("event_id", F.array(call).alias("messages"))
    outcomes = chat.repair_outcomes(samples, "event_id")
    made = F.col("messages")[0]["tool_calls"][0]["function"]["arguments"]
    return outcomes.select("event_id", "status", F.when(F.col("status") == chat.KEPT, made).alias("arguments"))


def negatives(spark, folder):
    return s.table(spark, folder, "benchmark").select(
        F.col("text").alias("abstract"), F.concat(F.lit("topic "), "item_id").alias("disease"),
        F.lit(None).cast("string").alias("genes"),
    )


@query(f"""WITH {s.LABELLED_DOCUMENTS},
real AS (SELECT 'real' AS origin, 'real:' || doc_id AS key, abstract, disease_name, gene
  FROM labelled WHERE abstract <> chr(32) || chr(9)),
negatives AS (SELECT text AS abstract, 'topic ' || item_id AS disease_name, 'n/a' AS gene FROM benchmark),
synthetic AS (SELECT 'synthetic' AS origin, 'synthetic:' || md5(md5(abstract) || md5(disease_name) || md5(gene)) || ':' ||
  row_number() OVER (PARTITION BY abstract, disease_name, gene) AS key, abstract, disease_name, gene FROM negatives),
mixed AS (SELECT * FROM real UNION ALL SELECT * FROM synthetic)
SELECT key, origin, {line_sql(PROMPT_SQL, 'disease_name', 'gene')} AS line,
  CASE WHEN row_number() OVER (ORDER BY md5('123:split:' || key), key)
  <= floor(0.95::DOUBLE * count(*) OVER ()) THEN 'train' ELSE 'validation' END AS split FROM mixed""")
def training_set(spark, folder):
    """Labelled and negative abstracts to mixed, split and repaired samples."""
    built = build_training_set(
        s.labelled_documents(spark, folder), negatives(spark, folder), EXTRACTION_PROMPT, real_key="doc_id"
    )
    return built.select("key", "origin", chat_line(built).alias("line"), "split")


def topics(spark, folder):
    return s.table(spark, folder, "part").select(F.col("p_name").alias("cancer_type"))


def number_sql(seed: str, key: str) -> str:
    return f"CAST('0x' || substr(md5('{seed}:' || {key}), 1, 8) AS BIGINT)"


PLAN = f"""topics AS (SELECT cancer_type, row_number() OVER (ORDER BY md5('123:' || cancer_type), cancer_type) - 1 AS number
  FROM (SELECT DISTINCT p_name AS cancer_type FROM part)),
picks AS (SELECT doc_id AS id, {number_sql('123:kind', 'doc_id')} / 4294967296.0::DOUBLE >= 0.2 AS is_cancer,
  {number_sql('123:topic', 'doc_id')} AS pick FROM documents),
plan AS (SELECT id, is_cancer,
  CASE WHEN is_cancer THEN cancer_type
    ELSE [{', '.join(quoted(t) for t in GENERAL_TOPICS)}][pick % {len(GENERAL_TOPICS)} + 1] END AS topic,
  CASE WHEN is_cancer THEN cancer_type ELSE 'n/a' END AS disease, 'n/a' AS genes
  FROM picks JOIN topics ON number = pick % (SELECT count(*) FROM topics))"""


def plan(spark, folder, **options):
    ids = s.table(spark, folder, "documents").select(F.col("doc_id").alias("id"))
    return synthesis.plan_negatives(ids, topics(spark, folder), **options)


@query(f"WITH {PLAN} SELECT * FROM plan")
def topic_plan(spark, folder):
    return plan(spark, folder)


@query(f"WITH {PLAN} SELECT * FROM plan WHERE id NOT IN (SELECT doc_id FROM labels)")
def resumed_topic_plan(spark, folder):
    return plan(spark, folder, existing=s.table(spark, folder, "labels").select(F.col("doc_id").alias("id")))


def prompt_sql(phrases: list[str]) -> str:
    return "printf(" + ", ".join(quoted(p) for p in [NEGATIVE_PROMPT]) + ", topic, " + ", ".join(map(quoted, phrases)) + ")"


PROMPTS = f"""{PLAN}, prompts AS (SELECT plan.*, CASE WHEN is_cancer THEN {prompt_sql(CANCER_PHRASES)}
  ELSE {prompt_sql(GENERAL_PHRASES)} END AS prompt FROM plan)"""


@query(f"WITH {PROMPTS} SELECT id, prompt FROM prompts")
def negative_prompt(spark, folder):
    rendered = synthesis.render_negative_prompt(plan(spark, folder))
    return rendered.select("id", F.col("messages")[1]["content"].alias("prompt"))


@query(f"""WITH {PROMPTS} SELECT id, 'A text of ' || length(prompt) || ' characters' AS abstract, disease, genes FROM prompts
  WHERE NOT contains(topic, 'anvil')""")
def generated_negatives(spark, folder):
    """Negative examples from a stand-in for a model, which fails on some topics."""

    def write(prompt):
        if "anvil" in prompt:
            raise ValueError("refused")
        return f"\nA text of {len(prompt)} characters "

    return negative_examples(plan(spark, folder), write)


@query(f"""WITH {PROMPTS} SELECT id, 'A text of ' || length(prompt) || ' characters' AS abstract, disease, genes FROM prompts
  WHERE NOT contains(topic, 'anvil') ORDER BY md5('123:' || id), id LIMIT (SELECT count(*) // 2 FROM documents)""")
def filled_negatives(spark, folder):
    """Exactly half as many examples as there are ids, whatever topics the stand-in fails on."""

    def write(prompt):
        if "anvil" in prompt:
            raise ValueError("refused")
        return f"A text of {len(prompt)} characters"

    ids = s.table(spark, folder, "documents").select(F.col("doc_id").alias("id"))
    return fill_negatives(ids, topics(spark, folder), write, ids.count() // 2, scratch_path(spark, "negatives"))
