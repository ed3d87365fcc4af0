"""Quality rules as a bitmask ledger, in native columns.

Every rule is evaluated once per document. The ledger keeps the measurements and one failure bit per rule, so
policies (named masks with a version) and ablations are bitwise arithmetic on the ledger, without reading texts again.

Null and empty texts have no words and fail ``few_words``. Repeated rows are judged row by row; an empty table gives
an empty ledger. Columns other than the id and the text are not read, so their names cannot clash. Very long texts are read whole; those
whose places do not fit beside a window's hash take the same steps on pairs of hash and place. Rules have no ties: a measurement at its bound does not fail.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What separates words, and the symbols that are counted.
SPACE = " \t\n\x0b\f\r"
SPACES = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "[#*$%&|<>]"
#: Bits of a packed window that hold its position.
PLACE = 20

#: name -> condition of failure, given a function from a measurement's name to its column. The position is the bit.
RULES: dict[str, Callable[[Callable[[str], Column]], Column]] = {
    "few_words": lambda m: m("n_words") < 50,
    "repeated_windows": lambda m: 100 * m("n_repeat_words") > 50 * m("n_words"),
    "many_symbols": lambda m: 10 * m("n_symbols") > m("n_words"),
    "repeated_lines": lambda m: 10 * m("n_dup_lines") > 5 * m("n_lines"),
    "short_words": lambda m: m("word_chars") < 2 * m("n_words"),
    "long_words": lambda m: m("word_chars") > 20 * m("n_words"),
}
BITS = {name: 1 << i for i, name in enumerate(RULES)}
BASE_MASK = BITS["few_words"] | BITS["repeated_windows"]
#: version -> mask of the rules that reject.
POLICIES = {"base": BASE_MASK, "lines-1": BASE_MASK | BITS["repeated_lines"], "full-1": sum(BITS.values())}
DEFAULT_POLICY = "full-1"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeated_words(words: Column) -> Column:
    """Number of words in 3-word windows that occur twice or more in ``words``, compared by their 64-bit hash.

    A window becomes one long: the upper bits of its hash over its position. Sorted, equal windows are neighbours:
    n log n in the words of one text, on plain longs. Neighbours whose whole hashes differ, or positions beyond
    ``PLACE`` bits, send a text through the same steps on (hash, position) pairs.
    """
    low = (1 << PLACE) - 1

    def key(w: Column, i: Column) -> Column:
        return F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))

    def near(s: Column, x: Column, j: Column, same: Callable[[Column, Column], Column]) -> Column:
        return F.coalesce(same(F.get(s, j - 1), x), F.lit(False)) | F.coalesce(same(F.get(s, j + 1), x), F.lit(False))

    def packed(w: Column) -> Column:
        return F.sort_array(F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: key(w, i).bitwiseAND(F.lit(~low)).bitwiseOR(i.cast("long"))))

    def alike(s: Column) -> Column:
        return F.filter(s, lambda x, j: near(s, x, j, lambda a, b: a.bitwiseXOR(b).bitwiseAND(F.lit(~low)) == 0))

    def place(x: Column) -> Column:
        return x.bitwiseAND(F.lit(low)).cast("int")

    def clash(w: Column, f: Column) -> Column:
        return F.exists(F.transform(f, lambda x, j: (
            (x.bitwiseXOR(F.get(f, j + 1)).bitwiseAND(F.lit(~low)) == 0) & (key(w, place(x)) != key(w, place(F.get(f, j + 1)))))), lambda x: F.coalesce(x, F.lit(False)))

    def pairs(w: Column) -> Column:
        s = F.sort_array(F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.struct(key(w, i).alias("h"), i.alias("i"))))
        return _let(s, lambda s: F.transform(F.filter(s, lambda x, j: near(s, x, j, lambda a, b: a["h"] == b["h"])), lambda x: x["i"]))

    def places(w: Column) -> Column:
        quick = _let(_let(packed(w), alike), lambda f: F.when(~clash(w, f), F.transform(f, place)))
        return F.coalesce(F.when(F.size(w) <= low, quick), pairs(w))

    def covered(p: Column) -> Column:
        own = F.transform(p, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(p, j + 1) - x, F.lit(3))))
        return F.aggregate(own, F.lit(0), lambda a, b: a + b)

    found = F.when(F.size(words) >= 3, F.sort_array(places(words)))
    return F.coalesce(_let(found, covered), F.lit(0))


def _parts(text: Column) -> tuple[Column, Column]:
    """What is computed from the words and from the lines of a text."""
    words = F.split(F.btrim(text, F.lit(SPACE)), SPACES)
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    by_word = _let(words, lambda w: F.struct(F.size(w).alias("n"), F.array_join(w, "").alias("solid"), _repeated_words(w).alias("repeat")))
    return by_word, _let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup")))


def _numbers(w: Column, x: Column) -> list[Column]:
    solid = w["solid"]
    return [c.cast("long").alias(n) for n, c in {
        "n_words": F.when(solid == "", F.lit(0)).otherwise(w["n"]),
        "word_chars": F.length(solid),
        "n_symbols": F.length(solid) - F.length(F.regexp_replace(solid, SYMBOLS, "")),
        "n_dup_lines": x["dup"],
        "n_repeat_words": w["repeat"],
        "n_lines": x["n"],
    }.items()]


def _bits(measured: Callable[[str], Column]) -> Column:
    bits = F.lit(0).cast("long")
    for name, rule in RULES.items():
        bits = bits.bitwiseOR(F.when(rule(measured), F.lit(BITS[name])).otherwise(F.lit(0)).cast("long"))
    return bits


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, measurements): each of them a count in whole texts."""
    by_word, by_line = _parts(F.coalesce(F.col(text_col), F.lit("")))
    return docs.select(F.col(id_col), by_word.alias("w"), by_line.alias("l")).select(id_col, *_numbers(F.col("w"), F.col("l")))


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, measurements, failed_bits): every rule evaluated once."""
    return measure(docs, id_col, text_col).withColumn("failed_bits", _bits(F.col))


def accepted(docs: DataFrame, policy: str = DEFAULT_POLICY, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the policy keeps, in one narrow pass; columns stay as they are."""
    by_word, by_line = _parts(F.coalesce(F.col(text_col), F.lit("")))
    numbers = _let(F.struct(by_word.alias("w"), by_line.alias("l")), lambda p: F.struct(*_numbers(p["w"], p["l"])))
    failed = _let(numbers, lambda m: _bits(lambda name: m[name]))
    return docs.where(failed.bitwiseAND(F.lit(POLICIES[policy]).cast("long")) == 0)


def apply_policy(entries: DataFrame, policy: str = DEFAULT_POLICY) -> DataFrame:
    """``entries`` with ``kept``: no failed bit is in the policy's mask; and the policy's name."""
    return entries.withColumn("kept", F.col("failed_bits").bitwiseAND(F.lit(POLICIES[policy]).cast("long")) == 0).withColumn("policy", F.lit(policy))


def ablations(entries: DataFrame) -> DataFrame:
    """(policy, rule, rejected, failed, alone) for every policy and each of its rules.

    ``rejected``: documents that the policy rejects; ``failed``: those that fail the rule; ``alone``: those that only
    this rule rejects, which would be kept without it. Documents are first counted by their bits (2 ** rules groups
    at most), so the rest works on a table of bounded size.
    """
    by_bits = entries.groupBy("failed_bits").agg(F.count("*").alias("n"))
    cases = [(policy, rule, mask, BITS[rule]) for policy, mask in POLICIES.items() for rule in RULES if mask & BITS[rule]]
    columns = []
    for policy, rule, mask, bit in cases:
        hit = F.col("failed_bits").bitwiseAND(F.lit(mask).cast("long"))
        total = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).cast("long")
        columns.append(F.struct(
            F.lit(policy).alias("policy"), F.lit(rule).alias("rule"), total(hit != 0).alias("rejected"),
            total(hit.bitwiseAND(F.lit(bit).cast("long")) != 0).alias("failed"), total(hit == bit).alias("alone")))
    return by_bits.agg(F.array(*columns).alias("cases")).select(F.explode("cases").alias("c")).select("c.*")
