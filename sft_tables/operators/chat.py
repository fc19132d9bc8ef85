"""Conversations: extraction, validation and expansion into one SFT row per assistant turn.

Array form: a conversation is one row (``messages``), everything happens inside the row, no shuffle.
Long form: one row per turn. Validation needs only the previous role, so it is done per block of turns
with one summary row per block; a conversation of any length never meets in one task. Only conversations
found valid are gathered, and there the last output cell holds the whole conversation anyway.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sft_tables.functions.carry import BLOCK, BLOCK_COL, block_window, running_total, with_block
from sft_tables.functions.errors import fault, first_fault
from sft_tables.functions.text import is_blank, nonblank, strip
from sft_tables.operators.rows import JsonRow

# Roles, the turn pattern of ChatML text, the ShareGPT speaker names.
ROLES = ("system", "user", "assistant")
SPEAKERS = {"human": "user", "gpt": "assistant"}
CHATML_TURN = (
    r"(?sU)<\|im_start\|>[\s\x1c-\x1f]*(system|user|assistant)[\s\x1c-\x1f]*\r?\n(.*?)<\|im_end\|>"
)
MESSAGES = "array<struct<is_object:boolean,role:string,content:string>>"


def _as_messages(field: str, role_key: str, content_key: str) -> Column:
    """Array of (is_object, role, content) from a variant list; values that are no strings become NULL."""
    def text(key: str) -> str:
        at = f"try_variant_get(m, '$.{key}', "
        return f"CASE WHEN schema_of_variant({at}'variant')) = 'STRING' THEN {at}'string') END"

    return F.expr(
        f"transform(try_variant_get(v, '$.{field}', 'array<variant>'), m -> struct("
        f"try_variant_get(m, '$', 'map<string,variant>') IS NOT NULL AS is_object, "
        f"{text(role_key)} AS role, {text(content_key)} AS content))"
    ).cast(MESSAGES)


def openai_messages() -> Column:
    return _as_messages("messages", "role", "content")


def sharegpt_messages() -> Column:
    """from/value pairs; the known speakers are renamed, any other name passes through."""
    return F.transform(
        _as_messages("conversations", "from", "value"),
        lambda m: m.withField("role", F.coalesce(_case(m["role"], SPEAKERS), m["role"])),
    ).cast(MESSAGES)


def _case(value: Column, table: dict[str, str]) -> Column:
    pairs = list(table.items())
    case = F.when(value == pairs[0][0], pairs[0][1])
    for key, result in pairs[1:]:
        case = case.when(value == key, result)
    return case


def parse_chatml(text: Column) -> Column:
    roles = F.regexp_extract_all(text, F.lit(CHATML_TURN), F.lit(1))
    bodies = F.regexp_extract_all(text, F.lit(CHATML_TURN), F.lit(2))
    return F.transform(F.arrays_zip(roles.alias("r"), bodies.alias("b")), lambda x: F.struct(
        F.lit(True).alias("is_object"), x["r"].alias("role"), strip(x["b"]).alias("content"),
    )).cast(MESSAGES)


def chatml_leftover(text: Column) -> Column:
    """True when something other than whole turns and whitespace is in the text."""
    return nonblank(F.regexp_replace(text, CHATML_TURN, ""))


def openai_structure_faults(row: JsonRow) -> list[tuple[Column, Column]]:
    return [
        (~row.is_object | ~row.present("messages"), fault("CHAT_MISSING", "messages")),
        (row.items("messages").isNull(), fault("CHAT_NOT_LIST", "messages")),
    ]


def sharegpt_structure_faults(row: JsonRow) -> list[tuple[Column, Column]]:
    items = row.items("conversations")
    strays = F.filter(
        F.transform(items, lambda m, i: F.when(F.try_variant_get(m, "$", "map<string,variant>").isNull(), i + 1)),
        lambda p: p.isNotNull(),
    )
    return [
        (~row.is_object | ~row.present("conversations"), fault("CHAT_MISSING", "conversations")),
        (items.isNull(), fault("CHAT_NOT_LIST", "conversations")),
        (F.size(strays) > 0, fault("TURN_NOT_OBJECT", turn=F.try_element_at(strays, F.lit(1)))),
    ]


def chatml_structure_faults(text: Column) -> list[tuple[Column, Column]]:
    return [
        (text.isNull(), fault("CHATML_NOT_TEXT")),
        ((F.size(F.regexp_extract_all(text, F.lit(CHATML_TURN), F.lit(1))) == 0) | chatml_leftover(text),
         fault("CHATML_MALFORMED")),
    ]


def turn_rules(role: Column, blank: Column, previous: Column) -> list[tuple[str, Column]]:
    """Rules of one turn, given only the role before it.

    That is enough: the first failing turn is wanted, so all turns before it obey the rules, and then the
    previous role tells whether the conversation has started and whether a user waits for an answer.
    """
    return [
        ("ROLE_UNKNOWN", role.isNull() | ~role.isin(*ROLES)),
        ("CONTENT_BLANK", blank),
        ("SYSTEM_LATE", (role == "system") & previous.isin("user", "assistant")),
        ("USER_TWICE", (role == "user") & (previous == "user")),
        ("ASSISTANT_ORPHAN", (role == "assistant") & (F.coalesce(previous, F.lit("system")) != "user")),
    ]


def _turn_code(role: Column, blank: Column, previous: Column) -> Column:
    rules = turn_rules(role, blank, previous)
    case = F.when(rules[0][1], rules[0][0])
    for code, condition in rules[1:]:
        case = case.when(condition, code)
    return case


def message_fault(messages: Column) -> Column:
    """First fault of a message array; a cheap pattern test clears valid rows before any detail work."""
    def letter(m: Column) -> Column:
        return F.when(m["role"] == "system", "s").when(m["role"] == "user", "u").when(m["role"] == "assistant", "a").otherwise("x")

    def blank(m: Column) -> Column:
        return F.coalesce(is_blank(m["content"]), F.lit(True))

    pattern = F.array_join(F.transform(messages, letter), "")
    clean = pattern.rlike("^s*(ua)+$") & F.forall(messages, lambda m: ~blank(m))

    def code(m: Column, i: Column) -> Column:
        previous = F.get(messages, i - 1)["role"]
        return F.when(~m["is_object"], "TURN_NOT_OBJECT").otherwise(_turn_code(m["role"], blank(m), previous))

    failing = F.filter(
        F.transform(messages, lambda m, i: F.struct(code(m, i).alias("code"), (i + 1).alias("turn"))),
        lambda x: x["code"].isNotNull(),
    )
    first = F.try_element_at(failing, F.lit(1))
    return F.when(clean, F.lit(None)).otherwise(first_fault([
        (F.coalesce(F.size(messages), F.lit(0)) <= 0, fault("CHAT_EMPTY")),
        (F.size(failing) > 0, fault(first["code"], turn=first["turn"])),
        (~F.exists(messages, lambda m: m["role"] == "assistant"), fault("NO_ASSISTANT")),
        (F.element_at(messages, -1)["role"] == "user", fault("ENDS_ON_USER")),
    ]))


def sft_of_messages(messages: str = "messages") -> Column:
    """Array of (turn, instruction, input, output), one per answered user turn."""
    history = (f"array_join(transform(slice({messages}, 1, greatest(i - 1, 0)), "
               "e -> concat(initcap(e.role), ': ', e.content)), chr(10))")
    question = f"get({messages}, i - 1)"
    return F.expr(
        f"filter(transform({messages}, (m, i) -> CASE WHEN m.role = 'assistant' AND {question}.role = 'user' THEN "
        f"struct(CAST(i + 1 AS BIGINT) AS turn, {question}.content AS instruction, {history} AS input, m.content AS output) END), "
        "r -> r IS NOT NULL)"
    )


def validate_messages(df: DataFrame, keys: list[str], messages: str = "messages") -> DataFrame:
    """Violations of conversations held as arrays."""
    return (
        df.select(*keys, message_fault(F.col(messages)).alias("f")).filter("f is not null")
        .select(*keys, "f.turn", "f.code")
    )


def expand_messages(df: DataFrame, keys: list[str], messages: str = "messages") -> DataFrame:
    """SFT rows of valid conversations held as arrays; no shuffle."""
    return (
        df.filter(message_fault(F.col(messages)).isNull())
        .select(*keys, F.explode_outer(sft_of_messages(messages)).alias("r")).select(*keys, "r.*")
    )


def gather_messages(turns: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Turn table to one row per conversation."""
    turn = F.struct("turn", F.lit(True).alias("is_object"), "role", "content")
    return turns.groupBy(conv).agg(F.array_sort(F.collect_list(turn)).alias("messages"))


def judge_blocks(turns: DataFrame, conv: str = "conv_id", block: int = BLOCK) -> DataFrame:
    """One row per block of turns with the verdict on its whole conversation (turn, code; NULL = valid)."""
    slim = with_block(
        turns.select(conv, "turn", "role", F.coalesce(is_blank("content"), F.lit(True)).alias("blank")), "turn", block
    )
    w = block_window([conv], "turn")
    seen = slim.withColumn("previous", F.lag("role").over(w)).withColumn("opens", F.lag("turn").over(w).isNull())
    inner = F.when(~F.col("opens"), _turn_code(F.col("role"), F.col("blank"), F.col("previous")))
    blocks = seen.withColumn("_code", inner).groupBy(conv, BLOCK_COL).agg(
        F.min(F.when(F.col("_code").isNotNull(), F.struct("turn", F.col("_code").alias("code")))).alias("bad"),
        F.min_by(F.struct("turn", "role", "blank"), "turn").alias("first"),
        F.max_by("role", "turn").alias("last_role"),
        F.count_if(F.col("role") == "assistant").alias("answers"),
    )
    per_conv = Window.partitionBy(conv)
    entry = _turn_code(F.col("first.role"), F.col("first.blank"), F.col("entering"))
    bad = F.when(F.col("_entry").isNotNull(), F.struct(F.col("first.turn").alias("turn"), F.col("_entry").alias("code"))).otherwise(F.col("bad"))
    judged = (
        blocks.withColumn("entering", F.lag("last_role").over(per_conv.orderBy(BLOCK_COL)))
        .withColumn("_entry", entry)
        .select(
            conv, BLOCK_COL,
            F.min(bad).over(per_conv).alias("bad"),
            F.sum("answers").over(per_conv).alias("answers"),
            F.max(F.struct(BLOCK_COL, "last_role")).over(per_conv).alias("end"),
            (F.min(BLOCK_COL).over(per_conv) == F.col(BLOCK_COL)).alias("leads"),
        )
    )
    code = F.when(F.col("bad").isNotNull(), F.col("bad.code")).when(F.col("answers") == 0, "NO_ASSISTANT").when(
        F.col("end.last_role") == "user", "ENDS_ON_USER")
    return judged.select(conv, BLOCK_COL, "leads", F.col("bad.turn").alias("turn"), code.alias("code"))


def validate_turns(turns: DataFrame, conv: str = "conv_id", block: int = BLOCK) -> DataFrame:
    """First violation of every invalid conversation of a turn table (conv, turn, role, content)."""
    return judge_blocks(turns, conv, block).filter("leads AND code IS NOT NULL").select(conv, "turn", "code")


def valid_turns(turns: DataFrame, conv: str = "conv_id", block: int = BLOCK) -> DataFrame:
    """Turns of valid conversations. The semi-join is on (conversation, block), so a huge invalid conversation
    spreads over tasks and is gone before turns are gathered."""
    valid = judge_blocks(turns, conv, block).filter("code IS NULL").select(conv, BLOCK_COL)
    return with_block(turns, "turn", block).join(valid, [conv, BLOCK_COL], "left_semi").drop(BLOCK_COL)


def expand_turns(turns: DataFrame, conv: str = "conv_id", block: int = BLOCK) -> DataFrame:
    """SFT rows of the valid conversations of a turn table."""
    gathered = gather_messages(valid_turns(turns, conv, block), conv)
    # report the stored turn number of the assistant turn
    return gathered.select(conv, "messages", F.explode_outer(sft_of_messages()).alias("r")).select(
        conv, F.get(F.col("messages"), (F.col("r.turn") - 1).cast("int"))["turn"].alias("turn"),
        "r.instruction", "r.input", "r.output",
    )
