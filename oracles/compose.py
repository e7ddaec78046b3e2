"""Puts the views a statement needs in front of it."""

from __future__ import annotations

import re

from oracles.statements import STATEMENTS
from oracles.views import VIEWS

_WORD = re.compile(r"[a-z_0-9]+")


def _needed(text: str) -> set[str]:
    found: set[str] = set()
    todo = [text]
    while todo:
        for name in set(_WORD.findall(todo.pop())) & VIEWS.keys() - found:
            found.add(name)
            todo.append(VIEWS[name])
    return found


def with_views(statement: str) -> str:
    needed = _needed(statement)
    views = [f"{name} AS MATERIALIZED ({VIEWS[name].strip()})" for name in VIEWS if name in needed]
    return ("WITH " + ",\n".join(views) + "\n" if views else "") + statement.strip()


def all_sql() -> dict[str, str]:
    return {key: with_views(statement) for key, statement in STATEMENTS.items()}
