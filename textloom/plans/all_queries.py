"""Import every query module so that the registry is complete."""

from __future__ import annotations


def load() -> None:
    from textloom.plans import queries_chat  # noqa: F401
    from textloom.plans import queries_json  # noqa: F401
    from textloom.plans import queries_small_vocab  # noqa: F401
    from textloom.plans import queries_tokenizer  # noqa: F401
