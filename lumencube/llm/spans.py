"""Code-point spans found in UTF-8 bytes."""

from __future__ import annotations

def code_points(raw: bytes, spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """The same spans counted in code points; ``spans`` are (kind, first byte, end byte)."""
    if not spans or raw.isascii():
        return spans
    places = sorted({x for _, s, e in spans for x in (s, e)})
    at, n, where = 0, 0, {}
    for x in places:
        n += len(raw[at:x].decode())
        at = x
        where[x] = n
    return [(kind, where[s], where[e]) for kind, s, e in spans]
