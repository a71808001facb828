"""Turn fields, role canonicalisation and the three chat renderers.

All renderers are higher-order array expressions over one conversation, so they
run map-side inside whole-stage codegen with no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, MapType, StructType

# Fixed values (must equal the reference): role spellings and their canonical form.
USER_ROLES = ["human", "user"]
ASSISTANT_ROLES = ["gpt", "assistant", "bot"]
SYSTEM_ROLES = ["system"]
IM_START = "<|im_start|>"
IM_END = "<|im_end|>"
RAW_PREFIX = {"user": "User: ", "assistant": "Assistant: ", "system": "System: "}
GENERATION_PROMPT = "<|im_start|>assistant\n"


def _pick(turn: Column, turn_type: DataType, first: str, second: str) -> Column:
    """Value of key ``first`` if present, else ``second`` if present, else ''.

    Presence is by key, not by value: a present null wins (dict.get semantics).
    For struct turns presence is decided by the schema, for map turns per row.
    """
    if isinstance(turn_type, StructType):
        names = set(turn_type.fieldNames())
        if first in names:
            return turn[first]
        if second in names:
            return turn[second]
        return F.lit("")
    if isinstance(turn_type, MapType):
        return (F.when(F.map_contains_key(turn, first), turn[first])
                .when(F.map_contains_key(turn, second), turn[second])
                .otherwise(F.lit("")))
    raise TypeError(f"turn must be a struct or a map, got {turn_type.simpleString()}")


def turn_role(turn: Column, turn_type: DataType) -> Column:
    return _pick(turn, turn_type, "from", "role").cast("string")


def turn_content(turn: Column, turn_type: DataType) -> Column:
    return _pick(turn, turn_type, "value", "content").cast("string")


def canonical_role(role: Column) -> Column:
    """Exact, case-sensitive mapping; anything else (incl. null) becomes null = dropped."""
    return (F.when(role.isin(USER_ROLES), F.lit("user"))
            .when(role.isin(ASSISTANT_ROLES), F.lit("assistant"))
            .when(role.isin(SYSTEM_ROLES), F.lit("system")))


def _content_text(content: Column, null_as: str | None = "None") -> Column:
    # Python's f-string prints a missing value as "None"; Spark concat would null the text.
    return content if null_as is None else F.coalesce(content, F.lit(null_as))


def known_turns(turns: Column, turn_type: DataType, null_content: str | None = "None") -> Column:
    """array<struct<role, content>> of the turns with a known role, roles canonical."""
    pairs = F.transform(turns, lambda t: F.struct(
        canonical_role(turn_role(t, turn_type)).alias("role"),
        _content_text(turn_content(t, turn_type), null_content).alias("content")))
    return F.filter(pairs, lambda x: x["role"].isNotNull())


def chatml_text(turns: Column, turn_type: DataType, null_content: str | None = "None") -> Column:
    """``<|im_start|>{role}\\n{content}<|im_end|>`` per known turn, newline-joined.

    Joining with a newline equals concatenating ``...<|im_end|>\\n`` and stripping:
    every rendering starts with the start marker and ends with one newline.
    """
    parts = F.transform(known_turns(turns, turn_type, null_content), lambda x: F.concat(
        F.lit(IM_START), x["role"], F.lit("\n"), x["content"], F.lit(IM_END)))
    return F.array_join(parts, "\n")


def raw_chat_text(turns: Column, turn_type: DataType, null_content: str | None = "None") -> Column:
    """P5: ``User: c`` / ``Assistant: c`` / ``System: c`` joined by a blank line, no strip."""
    parts = F.transform(known_turns(turns, turn_type, null_content), lambda x: F.concat(
        F.when(x["role"] == "user", F.lit(RAW_PREFIX["user"]))
         .when(x["role"] == "assistant", F.lit(RAW_PREFIX["assistant"]))
         .otherwise(F.lit(RAW_PREFIX["system"])),
        x["content"]))
    return F.array_join(parts, "\n\n")


def chat_template_text(messages: Column, add_generation_prompt: bool = False) -> Column:
    """The tokenizer chat template: every message verbatim, each followed by a newline.

    A null role or content is rendered as ``None``, as in P4 and P5; no message is lost.
    """
    none = F.lit("None")
    parts = F.transform(messages, lambda m: F.concat(
        F.lit(IM_START), F.coalesce(m["role"], none), F.lit("\n"), F.coalesce(m["content"], none), F.lit(IM_END + "\n")))
    body = F.array_join(parts, "")
    return F.concat(body, F.lit(GENERATION_PROMPT)) if add_generation_prompt else body


def nonempty_list(turns: Column) -> Column:
    """missing, null or empty list is dropped."""
    return F.coalesce(F.size(turns), F.lit(0)) > 0
