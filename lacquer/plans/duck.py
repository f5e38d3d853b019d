"""Pieces of DuckDB SQL the statements share."""

from __future__ import annotations

_SPACE = r"[\s\x{b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def trim(x: str) -> str:
    return f"regexp_replace({x}, '^{_SPACE}|{_SPACE}$', '', 'g')"


def blank(x: str) -> str:
    return f"{trim(f'coalesce({x}, chr(0))')} in ('', chr(0))"


def clean_list(x: str) -> str:
    """Distinct trimmed non-blank elements in order of first appearance, NULL as empty."""
    t = f"list_filter(list_transform(coalesce({x}, []), lambda e: {trim('coalesce(e, chr(32))')}), lambda e: e <> '')"
    return f"list_filter({t}, lambda e, i: list_position({t}, e) = i)"
