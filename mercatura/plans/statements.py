"""Puts oracle statements together from named parts, each carrying only the parts it needs."""

from __future__ import annotations

import re


def compose(parts: dict[str, str], select: str) -> str:
    """``select`` preceded by the common table expressions it reaches, in definition order."""
    needed: set[str] = set()
    waiting = [select]
    while waiting:
        words = set(re.findall(r"\w+", waiting.pop()))
        found = [name for name in parts if name in words and name not in needed]
        needed.update(found)
        waiting.extend(parts[name] for name in found)
    used = [f"{name} AS ({body})" for name, body in parts.items() if name in needed]
    return (f"WITH RECURSIVE {', '.join(used)} " if used else "") + select
