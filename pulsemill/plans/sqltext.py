"""SQL fragments of the text rules for the comparison engine."""

from __future__ import annotations

from pulsemill.functions.text import BEYOND_BMP, ILLEGAL

# The white space code points as the inside of a character class, and the marks a name may start with.
SPACE = r"\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
NAME_MARK = "^([∆Δ]~?|~)?"


def blank(x: str) -> str:
    return f"({x} IS NULL OR NOT regexp_matches({x}, '[^{SPACE}]'))"


def name(x: str) -> str:
    mark = f"regexp_extract({x}, '{NAME_MARK}', 0)"
    rest = f"regexp_replace(regexp_replace(substr({x}, length({mark}) + 1), '{BEYOND_BMP}', '--', 'g'), '{ILLEGAL}', '-', 'g')"
    return f"('\"' || {mark} || {rest} || '\"')"


def tag(x: str) -> str:
    trimmed = rf"regexp_replace({x}, '^[{SPACE}]+|[{SPACE}]+\z', '', 'g')"
    return f"('\"' || replace({trimmed}, '\"', '\\\"') || '\"')"


def number(x: str) -> str:
    return f"regexp_replace(regexp_replace(upper(CAST({x} AS VARCHAR)), '\\.0$', ''), '^-0$', '0')"


def source(x: str = "source", default: str = "unknown") -> str:
    return f"(' source=' || {tag(f'CASE WHEN {blank(x)} THEN {chr(39)}{default}{chr(39)} ELSE {x} END')})"


def optional(x: str) -> str:
    return f"coalesce(' ' || {x}, '')"


def delta(x: str) -> str:
    return f"(CASE WHEN substr({x}, 1, 1) IN ('∆', 'Δ') THEN {x} ELSE '∆' || {x} END)"


def bin_start(x: str, width: int = 60_000) -> str:
    return f"({x} // {width} * {width})"


# Point checks; tag columns are tag_k and tag_type.
POINT_REASON = f"""CASE WHEN {blank('name')} THEN 'blank_name' WHEN name IN ('∆', 'Δ') THEN 'bare_delta'
  WHEN value IS NULL OR isnan(value) OR isinf(value) THEN 'non_finite'
  WHEN {blank('tag_k')} OR {blank('tag_type')} THEN 'blank_tag_value'
  WHEN regexp_matches(coalesce(source, ''), '[\\r\\n]') OR regexp_matches(tag_k || tag_type, '[\\r\\n]') THEN 'newline' END"""

METRIC_LINE = f"""{name('name')} || ' ' || {number('value')} || {optional('ts_ms')} || {source()}
  || ' "k"=' || {tag('tag_k')} || ' "type"=' || {tag('tag_type')}"""
