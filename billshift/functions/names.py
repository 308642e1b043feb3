"""Names of helper columns that clash with none of the caller's."""

from __future__ import annotations

from collections.abc import Iterable


def unused(taken: Iterable[str], name: str) -> str:
    """``name``, lengthened until no column in ``taken`` has it, in any case."""
    lowered = {t.lower() for t in taken}
    while name.lower() in lowered:
        name += "_"
    return name
