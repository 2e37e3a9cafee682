"""Chat samples: building them, and repairing them before use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from litquarry.functions.answers import btrim_json, encode_answer, is_json
from litquarry.functions.binding import bind, keep_where
from litquarry.functions.hashing import seeded_hash
from litquarry.functions.text import null_to_na, render_prompt
from litquarry.operators.filters import drop_blank
from litquarry.operators.sampling import SEED
from litquarry.schemas import FULL_MESSAGE

# Roles that become `tool`, characters and length of a generated call id.
TOOL_ROLES = ["function", "tool"]
CALL_ID_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
CALL_ID_LENGTH = 9

KEPT, SKIPPED, REJECTED, MALFORMED = "kept", "skipped", "rejected", "malformed"


def build_chat(
    df: DataFrame, template: str, abstract: str = "abstract", disease: str = "disease_name", gene: str = "gene"
) -> DataFrame:
    """Rows with an abstract, as a user prompt and the assistant's JSON answer."""
    answer = encode_answer(null_to_na(disease), null_to_na(gene))
    turns = [("user", render_prompt(template, abstract)), ("assistant", answer)]
    messages = F.array(*[F.struct(F.lit(role).alias("role"), text.alias("content")) for role, text in turns])
    return drop_blank(df, abstract).withColumn("messages", messages)


def functions_to_tools(df: DataFrame) -> DataFrame:
    """A sample's `functions` become `tools`, each wrapped as one function."""
    wrapped = F.transform("functions", lambda f: F.concat(F.lit('{"function": '), f, F.lit("}")))
    tools = F.coalesce(wrapped, F.col("tools")) if "tools" in df.columns else wrapped
    return df.withColumn("tools", tools).drop("functions")


def conform(value: Column, given: T.DataType, wanted: T.DataType) -> Column:
    """A value with the fields of the wanted type, null where it has none."""
    if isinstance(wanted, T.StructType):
        present = {f.name: f.dataType for f in given.fields}
        fields = [
            (conform(value[f.name], present[f.name], f.dataType) if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in wanted.fields
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(wanted, T.ArrayType):
        return F.transform(value, lambda v: conform(v, given.elementType, wanted.elementType))
    return value.cast(wanted)


def full_messages(df: DataFrame) -> DataFrame:
    """Messages with every field of the chat schema, null where the sample has none."""
    given, wanted = df.schema["messages"].dataType, T.ArrayType(FULL_MESSAGE)
    return df if given == wanted else df.withColumn("messages", conform(F.col("messages"), given, wanted))


def _is_empty(text: Column) -> Column:
    return F.coalesce(text == "", F.lit(True))


def _without_call(message: Column) -> Column:
    """A message whose `function_call` has become `tool_calls`, without empty texts beside calls."""
    call = message["function_call"]
    calls = F.when(
        call.isNotNull(),
        F.array(F.struct(
            F.lit(None).cast("string").alias("id"),
            F.struct(call["name"].alias("name"), F.when(is_json(call["arguments"]), btrim_json(call["arguments"])).alias("arguments")).alias("function"),
            F.lit(None).cast("map<string,string>").alias("rest"),
        )),
    ).otherwise(message["tool_calls"])
    content = F.when(call.isNull(), message["content"])
    beside_call = calls.isNotNull()
    return F.struct(
        message["role"].alias("role"),
        F.when(~(beside_call & (content == "")), content).alias("content"),
        F.when(~(beside_call & (message["text"] == "")), message["text"]).alias("text"),
        message["name"].alias("name"),
        message["tool_call_id"].alias("tool_call_id"),
        calls.alias("tool_calls"),
        message["rest"].alias("rest"),
    )


def _bad_call(message: Column, fixed: Column) -> Column:
    """A function call that carries a text, or whose arguments are not JSON and so were not taken over."""
    arguments = F.get(fixed["tool_calls"], F.lit(0))["function"]["arguments"]
    return message["function_call"].isNotNull() & (~_is_empty(message["content"]) | arguments.isNull())


def _call_id(digest: Column) -> Column:
    """Letters and digits, each from three hex digits of a digest."""
    number = lambda i: F.conv(F.substring(digest, 3 * i + 1, 3), 16, 10).cast("int") % len(CALL_ID_LETTERS)
    return F.concat(*[F.substr(F.lit(CALL_ID_LETTERS), number(i) + 1, F.lit(1)) for i in range(CALL_ID_LENGTH)])


def _named_tool(key: Column, seed: int | str):
    """A tool message's role and call id; the id depends only on seed, sample and position."""

    def fix(message: Column, position: Column) -> Column:
        is_tool = message["role"].isin(*TOOL_ROLES)
        new_id = bind(seeded_hash(seed, F.concat_ws(":", key.cast("string"), position)), _call_id)
        return F.struct(
            F.when(is_tool, F.lit("tool")).otherwise(message["role"]).alias("role"),
            message["content"].alias("content"),
            message["text"].alias("text"),
            message["name"].alias("name"),
            F.when(is_tool, F.coalesce(message["tool_call_id"], new_id))
            .otherwise(message["tool_call_id"])
            .alias("tool_call_id"),
            message["tool_calls"].alias("tool_calls"),
            message["rest"].alias("rest"),
        )

    return fix


def _answers_call(message: Column, following: Column) -> Column:
    """True where an assistant message with calls is followed by a tool message."""
    return F.coalesce(
        (message["role"] == "assistant") & message["tool_calls"].isNotNull() & (following["role"] == "tool"),
        F.lit(False),
    )


def _linked_call(messages: Column):
    """An assistant's first call gets the id of the tool message that follows."""

    def fix(message: Column, position: Column) -> Column:
        following = F.get(messages, position + 1)
        linked = F.transform(
            message["tool_calls"],
            lambda call, i: F.struct(
                F.when(i == 0, following["tool_call_id"]).otherwise(call["id"]).alias("id"),
                call["function"].alias("function"),
                call["rest"].alias("rest"),
            ),
        )
        return message.withField(
            "tool_calls", F.when(_answers_call(message, following), linked).otherwise(message["tool_calls"])
        )

    return fix


def _other_tool(messages: Column):
    """True where a tool message does not answer the first call of the message before it."""

    def check(message: Column, position: Column) -> Column:
        following = F.get(messages, position + 1)
        first = F.get(message["tool_calls"], F.lit(0))["function"]["name"]
        return _answers_call(message, following) & ~first.eqNullSafe(following["name"])

    return check


def _finished(called: Column, named: Column, linked: Column) -> Column:
    """A sample's status, and its messages up to the last one by the assistant."""
    from_end = F.array_position(F.reverse(F.transform(linked, lambda m: m["role"])), "assistant")
    length = F.when(from_end > 0, F.size(linked) - from_end + 1).otherwise(0).cast("int")
    other_tool = F.exists(F.transform(named, _other_tool(named)), lambda bad: bad)
    no_text = F.exists(linked, lambda m: _is_empty(m["content"]) & _is_empty(m["text"]))
    status = (
        F.when(F.exists(F.zip_with(called, named, _bad_call), lambda bad: bad) | other_tool, F.lit(REJECTED))
        .when(no_text | (length == 0), F.lit(SKIPPED))
        .otherwise(F.lit(KEPT))
    )
    return F.struct(
        F.when(linked.isNull(), F.lit(KEPT)).otherwise(status).alias("status"),
        F.slice(linked, F.lit(1), length).alias("messages"),
    )


def repaired(messages: Column, key: Column, seed: int | str = SEED) -> Column:
    """Struct of a sample's `status` and its repaired `messages`."""
    return bind(
        F.transform(F.transform(messages, _without_call), _named_tool(key, seed)),
        lambda named: bind(
            F.transform(named, _linked_call(named)), lambda linked: _finished(messages, named, linked)
        ),
    )


def repair_outcomes(df: DataFrame, key: str, seed: int | str = SEED) -> DataFrame:
    """Every sample, repaired, with its `status`.

    malformed: a line that is no JSON object, where the reader has marked it so.
    rejected: a function call with a text, with arguments that are not JSON, or
    answered by another tool. skipped: a message without any text, or no assistant
    message. kept: the rest, ending on its last assistant message; a sample without
    a message list is kept as it is.
    """
    return _repaired_samples(df, key, seed, lambda r: r["status"].isNotNull())


def repair_chat(df: DataFrame, key: str, seed: int | str = SEED) -> DataFrame:
    """The samples that are kept, repaired."""
    return _repaired_samples(df, key, seed, lambda r: r["status"] == KEPT).drop("status", "malformed")


def _repaired_samples(df: DataFrame, key: str, seed: int | str, condition) -> DataFrame:
    tools = full_messages(functions_to_tools(df) if "functions" in df.columns else df)
    outcome = repaired(F.col("messages"), F.col(key), seed)
    if "malformed" in df.columns:
        malformed = F.col("malformed")
        outcome = bind(outcome, lambda r: F.struct(
            F.when(malformed, F.lit(MALFORMED)).otherwise(r["status"]).alias("status"),
            F.when(~malformed, r["messages"]).alias("messages"),
        ))
    done = keep_where(tools, outcome, condition, "_repaired")
    return done.withColumns({"messages": F.col("_repaired.messages"), "status": F.col("_repaired.status")}).drop(
        "_repaired"
    )


def repair_turns(
    turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Repair of conversations held one row per turn.

    Drops conversations with an empty turn or without an assistant turn, and the turns
    after the last assistant turn. The state of a conversation is one small row from a
    combined aggregate, so a very long conversation is never gathered in one place.
    """
    state = (
        turns.groupBy(conversation)
        .agg(
            F.max(F.when(F.col(role) == "assistant", F.col(turn))).alias("_last"),
            F.bool_or(_is_empty(F.col(text))).alias("_empty"),
        )
        .filter(F.col("_last").isNotNull() & ~F.col("_empty"))
    )
    joined = turns.join(state.select(conversation, "_last"), conversation)
    return joined.filter(F.col(turn) <= F.col("_last")).select(*turns.columns)
