"""DuckDB SQL fragments restating each operator's rule for the oracle check.

They read the driver's views (documents, conversations, benchmark) directly.
"""

from __future__ import annotations

NL = "chr(10)"
KNOWN_ROLES = "('user', 'assistant', 'system')"


def key_sql(seed: int = 42, source: str = "source", id_col: str = "id") -> str:
    return f"md5('{seed}:' || {source} || ':' || CAST({id_col} AS VARCHAR))"


def web_cte(n: int | None, name: str = "fineweb", table: str = "documents", id_col: str = "doc_id") -> str:
    cut = "" if n is None else (
        f" AND {id_col} <= (SELECT max({id_col}) FROM (SELECT {id_col} FROM {table} ORDER BY {id_col} LIMIT {n}))")
    return (f"SELECT '{name}' AS source, {id_col} AS id, text FROM {table} "
            f"WHERE length(text) > 0{cut}")


def _chat_ids(first: bool, n: int | None) -> str:
    cond = "conv_id % 10 < 7" if first else "conv_id % 10 >= 7"
    lim = "" if n is None else f" ORDER BY conv_id LIMIT {n}"
    return f"SELECT DISTINCT conv_id FROM conversations WHERE {cond}{lim}"


def chatml_part() -> str:
    return f"'<|im_start|>' || role || {NL} || coalesce(text, 'None') || '<|im_end|>'"


def raw_part() -> str:
    return ("CASE role WHEN 'user' THEN 'User: ' WHEN 'assistant' THEN 'Assistant: ' ELSE 'System: ' END"
            " || coalesce(text, 'None')")


def chat_cte(first: bool, n: int | None, style: str) -> str:
    name = "hermes" if first else "capybara"
    part, sep = (chatml_part(), NL) if style == "chatml" else (raw_part(), f"{NL} || {NL}")
    return (f"SELECT '{name}' AS source, conv_id AS id, string_agg({part}, {sep} ORDER BY turn) AS text "
            f"FROM conversations WHERE conv_id IN ({_chat_ids(first, n)}) AND role IN {KNOWN_ROLES} "
            f"GROUP BY conv_id")


def holdout_sql(inner: str, ratio: float = 0.05, at_least_one: bool = False, cols: str = "*") -> str:
    """Rows of ``inner`` (source, id, text) with key and split; first k by key are valid."""
    k = f"CAST(floor(count(*) OVER () * CAST({ratio} AS DOUBLE)) AS BIGINT)"
    if at_least_one:
        k = f"greatest(1, {k})"
    return (f"SELECT {cols} FROM (SELECT *, CASE WHEN row_number() OVER (ORDER BY key, source, id) <= {k} "
            f"THEN 'valid' ELSE 'train' END AS split FROM (SELECT *, {key_sql()} AS key FROM ({inner}) s) k) t")
