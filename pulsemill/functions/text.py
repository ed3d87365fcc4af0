"""Text rules of the line protocol, as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulsemill.model import DELTA_PREFIX, DELTA_PREFIX_ALT, UNKNOWN_SOURCE

# The Unicode white space code points.
SPACES = (
    "\t\n\v\f\r \u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# What a name may not contain, and the marks it may start with.
ILLEGAL = r"[^,\-.0-9A-Za-z_]"
LEGAL = r"\A[,\-.0-9A-Za-z_]*\z"
BEYOND_BMP = r"[\x{10000}-\x{10FFFF}]"
TILDE = "~"


def _printed(text: Column) -> Column:
    """Whether ``text`` starts with a visible ASCII character: two comparisons of bytes, where trimming takes a text apart."""
    return (text >= "!") & (text < "\x7f")


def blank(text: Column) -> Column:
    """True for null, empty and all-white-space text."""
    return text.isNull() | (~_printed(text) & (F.ltrim(text, F.lit(SPACES)) == ""))


def trim_space(text: Column) -> Column:
    """Trim every kind of Unicode white space (the default trim only strips blanks)."""
    return F.when(_printed(text) & _printed(F.substring(text, -1, 1)), text).otherwise(F.btrim(text, F.lit(SPACES)))


def sanitize_name(name: Column) -> Column:
    """Quoted metric name or tag key; each illegal UTF-16 unit becomes one ``-``.

    A leading delta sign, tilde, or delta sign plus tilde is kept. Most names are legal as they are, which one match tells.
    """
    return F.when(name.rlike(LEGAL), F.concat(F.lit('"'), name, F.lit('"'))).otherwise(_with_dashes(name))


def _with_dashes(name: Column) -> Column:
    delta_tilde = name.startswith(DELTA_PREFIX + TILDE) | name.startswith(DELTA_PREFIX_ALT + TILDE)
    one_mark = name.startswith(TILDE) | name.startswith(DELTA_PREFIX) | name.startswith(DELTA_PREFIX_ALT)
    marks = F.when(delta_tilde, 2).when(one_mark, 1).otherwise(0)
    # Only text with multi-byte characters can hold a character of two UTF-16 units.
    units = F.when(F.octet_length(name) == F.length(name), name).otherwise(F.regexp_replace(name, BEYOND_BMP, "--"))
    legal = F.regexp_replace(F.substr(units, marks + 1), ILLEGAL, "-")
    return F.concat(F.lit('"'), F.substr(name, F.lit(1), marks), legal, F.lit('"'))


def sanitize_tag_value(value: Column) -> Column:
    """Quoted source or tag value: trimmed, double quotes escaped, everything else kept."""
    return F.concat(F.lit('"'), F.replace(trim_space(value), F.lit('"'), F.lit('\\"')), F.lit('"'))


def delta_name(name: Column) -> Column:
    """Prefix the delta sign unless either delta sign is already there."""
    marked = name.startswith(DELTA_PREFIX) | name.startswith(DELTA_PREFIX_ALT)
    return F.when(marked, name).otherwise(F.concat(F.lit(DELTA_PREFIX), name))


def bare_delta(name: Column) -> Column:
    """True for a name that is only a delta sign."""
    return name.isin(DELTA_PREFIX, DELTA_PREFIX_ALT)


def with_default_source(source: Column, default: str = UNKNOWN_SOURCE) -> Column:
    """The source, or ``default`` where it is blank."""
    return F.when(blank(source), F.lit(default)).otherwise(source)


def number_text(value: Column) -> Column:
    """Invariant, shortest number text: no trailing ``.0``; plain digits for 1e-4 <= |x| < 1e15, else ``dE+dd``.

    Whole numbers go through an integer. Where the JVM writes an exponent, the decimal point is moved in its text, so no
    digit is rounded.
    """
    raw = value.cast("string")
    whole = (F.rint(value) == value) & (F.abs(value) < 1e15)
    return (
        F.when(whole, value.cast("bigint").cast("string"))
        .when(raw.contains("E"), _from_exponent_text(raw, value))
        .otherwise(raw)
    )


def _from_exponent_text(raw: Column, value: Column) -> Column:
    # ``transform`` over one-element arrays names intermediate results, so that each is computed once per row.
    parts = F.array(F.struct(
        F.regexp_replace(F.substring_index(raw, "E", 1), "-", "").alias("mantissa"),
        F.substring_index(raw, "E", -1).try_cast("int").alias("exponent"),
        F.abs(value).alias("size"),
    ))
    shortest = F.transform(parts, _shorten)
    digits = F.transform(shortest, lambda p: F.struct(
        F.regexp_replace(F.replace(p["mantissa"], F.lit("."), F.lit("")), r"0+\z", "").alias("digits"), p["exponent"].alias("exponent")))
    sign = F.when(raw.startswith("-"), F.lit("-")).otherwise(F.lit(""))
    return F.concat(sign, F.element_at(F.transform(digits, _move_point), 1))


def _shorten(p: Column) -> Column:
    """Older JVMs may write more digits than needed: take 15 or 16 where they name the same number."""
    exact, exponent = p["mantissa"], p["exponent"]

    def shorter(digits: int) -> tuple[Column, Column]:
        text = F.round(exact.try_cast("decimal(20,17)"), digits - 1).cast("string")
        same = F.concat(text, F.lit("E"), exponent.cast("string")).try_cast("double") == p["size"]
        return (F.length(exact) > digits + 1) & same & (F.length(text) == digits + 1), text

    choice = F.when(*shorter(15)).when(*shorter(16)).otherwise(exact)
    return F.struct(choice.alias("mantissa"), exponent.alias("exponent"))


def _move_point(p: Column) -> Column:
    digits, exponent = p["digits"], p["exponent"]
    padded = F.rpad(digits, F.greatest(exponent + 1, F.length(digits)), F.lit("0"))
    fraction = F.substr(padded, exponent + 2)
    large = F.concat(
        F.substr(padded, F.lit(1), exponent + 1),
        F.when(F.length(fraction) > 0, F.concat(F.lit("."), fraction)).otherwise(F.lit("")),
    )
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -exponent - 1), digits)
    tail = F.substr(digits, F.lit(2))
    power = F.abs(exponent).cast("string")
    scientific = F.concat(
        F.substr(digits, F.lit(1), F.lit(1)),
        F.when(F.length(tail) > 0, F.concat(F.lit("."), tail)).otherwise(F.lit("")),
        F.when(exponent < 0, F.lit("E-")).otherwise(F.lit("E+")),
        F.lpad(power, F.greatest(F.length(power), F.lit(2)), F.lit("0")),
    )
    return F.when(exponent.between(0, 14), large).when(exponent.between(-4, -1), small).otherwise(scientific)


def semver_number(version: Column) -> Column:
    """First ``d.d.d`` of a version as ``major.MMPP``; one-digit parts padded to two; 0.0 when there is none."""
    # Fixed value: the version pattern.
    pattern = r"([0-9]\d*)\.(\d+)\.(\d+)(?:-([a-zA-Z0-9]+))?"

    def two(part: Column) -> Column:
        return F.when(F.length(part) == 1, F.concat(F.lit("0"), part)).otherwise(part)

    major, minor, patch = (F.regexp_extract(version, pattern, i) for i in (1, 2, 3))
    text = F.concat(major, F.lit("."), two(minor), two(patch))
    return F.coalesce(F.when(F.length(major) > 0, text.try_cast("double")), F.lit(0.0))
