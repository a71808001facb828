"""Conversation assembly and rendering frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions.chat import chat_template_text, chatml_text, nonempty_list, raw_chat_text


def group_turns(flat: DataFrame, fields: dict[str, str], out: str,
                conv_col: str = "conv_id", order_col: str = "turn") -> DataFrame:
    """Flat turn rows -> one row per conversation with an ordered array of turn structs.

    ``collect_list`` has no order, so turns are collected with their position and
    sorted inside the row.  One group is one conversation (a single sample).
    """
    entry = F.struct(F.col(order_col).alias("pos"), *[F.col(src).alias(dst) for dst, src in fields.items()])
    grouped = flat.groupBy(F.col(conv_col).alias("id")).agg(F.array_sort(F.collect_list(entry)).alias("t"))
    names = list(fields)
    return grouped.select("id", F.transform("t", lambda x: F.struct(*[x[n].alias(n) for n in names])).alias(out))


def nonempty_text(df: DataFrame, text_col: str = "text") -> DataFrame:
    """truthy text: not null and not ''; whitespace-only text is kept."""
    return df.where(F.length(F.col(text_col)) > 0)


def render_chat(df: DataFrame, turns_field: str, style: str = "chatml",
                null_content: str | None = "None") -> DataFrame:
    """Chat items -> ``(id, text)`` with F2 (non-empty list) and F4 (non-empty rendering).

    A missing list field behaves like ``item.get(field, [])``: no rows.
    """
    if turns_field not in df.columns:
        return df.sparkSession.createDataFrame([], "id BIGINT, text STRING")
    turn_type = df.schema[turns_field].dataType.elementType
    render = {"chatml": chatml_text, "raw": raw_chat_text}[style]
    out = (df.where(nonempty_list(F.col(turns_field)))
           .select("id", render(F.col(turns_field), turn_type, null_content).alias("text")))
    return out.where(F.col("text") != "")


def render_template(df: DataFrame, messages_col: str = "messages",
                    add_generation_prompt: bool = False) -> DataFrame:
    """Tokenizer chat template over ``messages`` (role verbatim, nothing dropped)."""
    return df.select("id", chat_template_text(F.col(messages_col), add_generation_prompt).alias("text"))
