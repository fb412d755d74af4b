"""Column names inside SQL expressions."""

from __future__ import annotations


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
