"""Personal data: base patterns, high-recall generators, and boosted trees that choose among their spans.

All of it runs as native columns. Base patterns give spans that always stay. Generators propose further spans: one for addresses and several for numbers
(phone groupings, card and account numbers, plain runs, anything long), so they overlap, and each finds its form at any digit group, also
inside a longer run of numbers or behind a base span. A candidate is described by its format and its context, scored by gradient-boosted trees written
as column expressions, and chosen if its calibrated probability reaches the threshold of its generator. The trees are
trained on labelled examples that a fixed rule writes (``labelled_examples``), neighbouring numbers among them; their features come from the same column
expressions. A candidate inside a base span gives way; of chosen ones that overlap, in order of their starts, the more probable one stays.

Spans are in code points, end exclusive. Null texts count as empty and have no spans; a redacted null stays null. Rows are
independent, so repeated rows give the same row again and an empty table gives none. Whole texts are searched;
the patterns run in linear time, as they never start within a run that has failed, and spans are compared in one sweep in order of their starts. Ties go to the earlier
start and the earlier generator. Other columns are kept and never read, whatever their names.
"""

from __future__ import annotations

import random
from functools import lru_cache, reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The base patterns, in the order of their kinds. Possessive and anchored where that finds the same.
LOCAL = "[A-Za-z0-9._%+-]"
KINDS = ["email", "ip", "card", "phone", "mail_form", "number_form"]
BASE = [
    f"(?:\\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++",
    "(?<![0-9])[0-9]++\\.[0-9]++\\.[0-9]++\\.[0-9]++",
    "[0-9](?:[\\x20-]?[0-9])++",
    "\\+[0-9][\\x20().0-9-]+[0-9]",
]
OCTETS = "^0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})(?:\\.0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})){3}$"
_SEP = "[\\x20.-]"
#: (kind number, pattern). Numbers start and end at the border of a digit group.
GENERATORS = [
    (4, "[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}+\\x20?(?:@|\\(at\\)|\\[at\\])\\x20?[A-Za-z0-9-]{1,63}+(?:\\x20?(?:\\.|\\(dot\\)|\\[dot\\])\\x20?[A-Za-z0-9-]{1,63}+){1,8}"),
    (5, f"(?<![0-9])(?:\\([0-9]{{3}}\\)\\x20?|[0-9]{{3}}{_SEP})[0-9]{{3}}{_SEP}[0-9]{{4}}(?![0-9])"),
    (5, "(?<![0-9])0[0-9]{2,4}[\\x20/-][0-9]{3}[\\x20-]?[0-9]{3,4}(?![0-9])"),
    (5, "\\+[0-9]{1,3}(?:[\\x20().-]{1,2}[0-9]{2,4}){2,4}(?![0-9])"),
    (5, "(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    (5, "(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\\x20?[A-Z0-9]{4}){2,7}(?:\\x20?[A-Z0-9]{1,4})?(?![A-Za-z0-9])"),
    (5, "(?<![0-9])(?:[0-9]{4}[\\x20-][0-9]{4}[\\x20-][0-9]{4}[\\x20-][0-9]{4}|[0-9]{4}[\\x20-][0-9]{6}[\\x20-][0-9]{5}|[0-9]{13,16})(?![0-9])"),
    (5, "(?<![0-9])[0-9]{7,12}(?![0-9])"),
    (5, "[+(]?[0-9](?:[\\x20().-]{0,2}[0-9]){6,24}+"),
]
HINTS = "\\b(?:tel|phone|fon|mobile|cell|call|fax|mail|e-mail|contact|write|card|visa|ssn|social security|account|iban|passport)\\b"
DOUBTS = "\\b(?:version|order|invoice|isbn|issn|item|part|ref|serial|release|page|lines?|total|price|population|date|on|since|in|between|build)\\b"

TREES, DEPTH, RATE = 40, 2, 0.3
#: Precision that the threshold of each generator must reach on held-out examples.
PRECISION = 0.98
FEATURES = ["generator", "size", "digits", "letters", "groups", "plus", "paren", "dots", "dashes", "spaces", "luhn", "octets", "hint", "doubt", "joined", "beside", "led"]


def _let(value: Column, body) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


_SPAN = "array<struct<start:int,end:int,s:string,before:string,after:string>>"
_RUN = 128


def _offsets(sizes: Column) -> Column:
    """The sum of the sizes before each place, and of all of them. Sums grow in blocks, so no long array is copied again and again."""
    def grow(values: Column) -> Column:
        return F.aggregate(values, F.array(F.lit(0)), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))

    def cut(values: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor(F.greatest(F.size(values) - 1, F.lit(0)) / _RUN).cast("int")), lambda k: grow(F.slice(values, k * _RUN + 1, _RUN)))

    def joined(parts: Column) -> Column:
        return _let(grow(F.transform(parts, lambda p: F.element_at(p, -1))), lambda heads: F.concat(
            F.flatten(F.transform(parts, lambda p, k: F.transform(F.slice(p, 1, F.size(p) - 1), lambda x: x + F.get(heads, k)))),
            F.array(F.element_at(heads, -1))))

    # Whatever a lambda looks at again and again is bound first, as it would be computed for each element.
    return _let(_let(sizes, cut), joined)


def _find(text: Column, pattern: str) -> Column:
    """(start, end, s, before, after) of the leftmost non-overlapping matches, with 24 characters before and one behind: gaps
    from a split, matches from an extraction."""
    def place(matches: Column, gaps: Column) -> Column:
        lengths = F.transform(matches, lambda x, i: F.length(F.get(gaps, i)) + F.length(x))
        return _let(_offsets(lengths), lambda at: F.transform(matches, lambda x, i: F.struct(
            (F.get(at, i) + F.length(F.get(gaps, i))).alias("start"), F.get(at, i + 1).alias("end"), x.alias("s"),
            F.lower(F.right(F.concat(F.coalesce(F.get(matches, i - 1), F.lit("")), F.get(gaps, i)), F.lit(24))).alias("before"),
            F.left(F.concat(F.get(gaps, i + 1), F.coalesce(F.get(matches, i + 1), F.lit(""))), F.lit(1)).alias("after"))))

    both = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("matches"), F.split(text, pattern, -1).alias("gaps"))
    return _let(both, lambda x: place(x["matches"], x["gaps"]))


def _only(text: Column, pattern: str, guard: Column) -> Column:
    return F.when(guard, _find(text, pattern)).otherwise(F.array().cast(_SPAN))


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _luhn(s: Column) -> Column:
    """Whether 12 to 19 digits pass the Luhn check."""
    def total(d: Column) -> Column:
        value = lambda i: F.substring(d, F.length(d) - i + 1, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return F.aggregate(F.transform(F.sequence(F.lit(1), F.length(d)), lambda i: value(i) % 10 + F.floor(value(i) / 10).cast("int")), F.lit(0), lambda a, b: a + b)

    return _let(_digits(s), lambda d: F.when(F.length(d).between(12, 19), total(d) % 10 == 0).otherwise(F.lit(False)))


def base_spans(text: Column) -> Column:
    """Sorted array of (start, kind number, end) of the base patterns whose matches hold."""
    has_digit = text.rlike("[0-9]")
    found = [
        _only(text, BASE[0], F.contains(text, F.lit("@"))),
        F.filter(_only(text, BASE[1], text.rlike("[0-9]\\.[0-9]")), lambda x: x["s"].rlike(OCTETS)),
        F.filter(_only(text, BASE[2], has_digit & text.rlike("[0-9](?:[\\x20-]?[0-9]){11}")), lambda x: _luhn(x["s"])),
        F.filter(_only(text, BASE[3], text.rlike("\\+[0-9]")), lambda x: F.length(_digits(x["s"])).between(9, 15)),
    ]

    def of_kind(k: int) -> Column:
        return F.transform(found[k], lambda x: F.struct(x["start"].alias("start"), F.lit(k).alias("kind"), x["end"].alias("end")))

    return F.sort_array(F.concat(*map(of_kind, range(len(found)))))


def candidates(text: Column) -> Column:
    """Array of (start, generator, end, s, before, after) in order of their starts: what the generators propose."""
    mail, number = text.rlike("@|\\(at\\)|\\[at\\]"), text.rlike("[0-9](?:[\\x20()./-]{0,2}[0-9]){6}")
    guards = [mail, *[number] * 4, text.rlike("[A-Z]{2}[0-9]{2}\\x20?[A-Z0-9]{4}"), *[number] * 3]

    def described(g: int, found: Column) -> Column:
        return F.transform(found, lambda x: F.struct(
            x["start"].alias("start"), F.lit(g).alias("generator"), x["end"].alias("end"), x["s"].alias("s"), x["before"].alias("before"), x["after"].alias("after")))

    return F.sort_array(F.concat(*[described(g, _only(text, p, guards[g])) for g, (_, p) in enumerate(GENERATORS)]))


def features(c: Column) -> dict[str, Column]:
    """The features of a candidate, as integer columns."""
    s, flag = c["s"], lambda x: F.when(x, 1).otherwise(0)
    return {
        "generator": c["generator"], "size": F.length(s), "digits": F.length(_digits(s)), "letters": F.length(F.regexp_replace(s, "[^A-Za-z]", "")),
        "groups": F.size(F.split(s, "[^0-9]+")), "plus": flag(F.startswith(s, F.lit("+"))), "paren": flag(F.contains(s, F.lit("("))),
        "dots": F.length(F.regexp_replace(s, "[^.]", "")), "dashes": F.length(F.regexp_replace(s, "[^-]", "")), "spaces": F.length(F.regexp_replace(s, "[^ ]", "")),
        "luhn": flag(_luhn(s)), "octets": flag(s.rlike(OCTETS)), "hint": flag(c["before"].rlike(HINTS)), "doubt": flag(F.regexp_replace(c["before"], "^.*[0-9]", "").rlike(DOUBTS)),
        "joined": flag(c["before"].rlike("[A-Za-z0-9_/=#$.-]$") | c["after"].rlike("[A-Za-z0-9_/=%]")),
        "beside": flag(c["before"].rlike("[0-9][\\x20,;)]{1,2}$")), "led": flag(c["before"].rlike("\\+[0-9]{1,3}[\\x20().-]{1,2}$")),
    }


def labelled_examples(n: int = 2400, seed: int = 4) -> list[tuple[str, list[tuple[int, int]]]]:
    """(text, places of personal data): written by a fixed rule, also with numbers right beside each other. Plain runs of
    digits count only behind a word that tells what they are."""
    rng = random.Random(seed)
    d = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    w = lambda: "".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(3, 8)))
    at, dot = lambda: rng.choice(["@", " (at) ", "[at]", "(at)"]), lambda: rng.choice([".", " (dot) ", "[dot]"])
    luhn = lambda s: sum((int(c) * (1 + i % 2)) // 10 + (int(c) * (1 + i % 2)) % 10 for i, c in enumerate(reversed(s))) % 10 == 0

    def card(k: int = 16) -> str:
        head = str(rng.choice([3, 4, 5, 6])) + d(k - 2)
        return next(head + c for c in "0123456789" if luhn(head + c))

    yes = [
        lambda: f"{w()}{rng.choice(['.', '_', ''])}{w()}{at()}{w()}{dot()}{rng.choice(['com', 'org', 'net', 'de'])}",
        lambda: f"({d(3)}) {d(3)}-{d(4)}", lambda: f"+{d(2)} {d(3)} {d(3)} {d(4)}", lambda: f"{d(3)}-{d(2)}-{d(4)}", lambda: f"0{d(2)} {d(3)} {d(4)}",
        lambda: f"0{d(3)}-{d(3)}{d(4)}", lambda: f"{d(3)}-{d(3)}-{d(4)}", lambda: f"{d(3)}.{d(3)}.{d(4)}", lambda: f"{d(3)} {d(3)} {d(4)}",
        lambda: " ".join(card()[i : i + 4] for i in range(0, 16, 4)), lambda: "-".join([(c := card())[:4], c[4:8], c[8:12], c[12:]]),
        lambda: f"{rng.choice(['DE', 'GB', 'FR', 'ES', 'NL'])}{d(2)} {d(4)} {d(4)} {d(4)} {d(4)} {d(2)}",
    ]
    beside = [lambda: f"192.168.{rng.randint(0, 255)}.{rng.randint(0, 255)}", lambda: f"20{d(2)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}"] * 2
    told = [lambda: d(10), lambda: d(9), lambda: "0" + d(10), lambda: d(7)]  # only with a hint
    no = [
        lambda: f"{d(4)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}", lambda: f"{d(2)}.{d(2)}.{d(2)}.{d(2)}.{d(2)}", lambda: d(rng.randint(7, 12)), lambda: f"978-{d(1)}-{d(4)}-{d(4)}-{d(1)}",
        lambda: f"{d(2)} {d(3)} {d(3)}", lambda: f"{d(4)}-{d(4)}", lambda: d(rng.randint(14, 24)), lambda: f"{d(3)}.{d(4)}.{d(2)}", lambda: f"{d(1)} {d(2)} {d(1)} {d(3)} {d(2)}",
        lambda: f"{rng.randint(10, 28)}.{rng.randint(10, 12)}.20{d(2)} {d(2)}:{d(2)}", lambda: " ".join(d(rng.randint(1, 3)) for _ in range(rng.randint(4, 9))),
    ]
    hints, doubts = ["tel", "phone", "call", "contact", "mobile", "mail", "fax"], ["version", "order", "invoice", "isbn", "serial", "since", "part"]
    out = []
    for _ in range(n):
        text, places, kind = f"{w()} {w()} ", [], rng.random()
        if kind < 0.12:
            parts = [(rng.choice(hints), rng.choice(told), 1)]
        elif kind < 0.45:
            parts = [(rng.choice(hints) if rng.random() < 0.6 else w(), rng.choice(yes), 1)]
        elif kind < 0.7:  # several numbers in a row, with dates and addresses of hosts among them
            parts = [(rng.choice([*hints, w(), w()]) if not i else "", rng.choice([*yes, *yes, *beside]), 1) for i in range(rng.randint(2, 4))]
        else:
            parts = [(rng.choice(doubts) if rng.random() < 0.5 else rng.choice(hints) if rng.random() < 0.03 else w(), rng.choice(no), 0)]
        for word, make, label in parts:
            glue = rng.choice(["/", "-", "x", "="]) if not label and rng.random() < 0.2 else " "
            text += (word + rng.choice([":", "", "."]) + glue if word else "")
            body = make()
            if label and make not in beside:
                places.append((len(text), len(text) + len(body)))
            text += body + (" " if word or rng.random() < 0.8 else ", ")
        out.append((f"{text}{w()} {w()}", places))
    return out


def boost(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE) -> tuple[float, list]:
    """(prior, trees) of logistic gradient boosting; a tree is a leaf value or (feature, limit, left, right), left at most the limit."""
    prior = float(np.log(y.mean() / (1 - y.mean())))
    score, out = np.full(len(y), prior), []

    def grow(rows: np.ndarray, gradient: np.ndarray, weight: np.ndarray, left: int):
        g, h = gradient[rows], weight[rows]
        leaf = round(float(rate * g.sum() / (h.sum() + 1)), 6)
        best = (1e-6, None, None)
        for f in range(x.shape[1]) if left and len(rows) > 20 else []:
            v = x[rows, f]
            for limit in np.unique(v)[:-1]:
                m = v <= limit
                gain = g[m].sum() ** 2 / (h[m].sum() + 1) + g[~m].sum() ** 2 / (h[~m].sum() + 1) - g.sum() ** 2 / (h.sum() + 1)
                if gain > best[0]:
                    best = gain, f, int(limit)
        if best[1] is None:
            score[rows] += leaf
            return leaf
        m = x[rows, best[1]] <= best[2]
        return best[1], best[2], grow(rows[m], gradient, weight, left - 1), grow(rows[~m], gradient, weight, left - 1)

    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        out.append(grow(np.arange(len(y)), y - p, p * (1 - p), depth))
    return prior, out


def _value(tree, row: np.ndarray) -> float:
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


@lru_cache(4)
def _trained(spark: SparkSession) -> tuple[float, tuple, tuple[float, float], tuple[float, ...]]:
    """(prior, trees, calibration, thresholds by generator), from the labelled examples: a few numbers."""
    table = spark.createDataFrame(labelled_examples(), "text string, places array<struct<start:int,end:int>>")
    described = table.select("places", F.explode(candidates(F.col("text"))).alias("c")).select(
        F.array_contains("places", F.struct(F.col("c.start").alias("start"), F.col("c.end").alias("end"))).cast("int").alias("label"),
        *[v.cast("int").alias(n) for n, v in features(F.col("c")).items()])
    rows = np.array(sorted(tuple(r) for r in described.collect()), float)
    rows = rows[np.random.default_rng(7).permutation(len(rows))]
    fit, held = rows[: 2 * len(rows) // 3], rows[2 * len(rows) // 3 :]
    prior, trees = boost(fit[:, 1:], fit[:, 0])
    raw = np.array([prior + sum(_value(t, r) for t in trees) for r in held[:, 1:]])
    slope, shift, n_yes = 1.0, 0.0, held[:, 0].sum()
    aim = np.where(held[:, 0] == 1, (n_yes + 1) / (n_yes + 2), 1 / (len(held) - n_yes + 2))
    for _ in range(500):  # Platt scaling on held-out examples, with smoothed labels
        p = 1 / (1 + np.exp(-(slope * raw + shift)))
        slope -= 0.05 * float(((p - aim) * raw).mean())
        shift -= 0.05 * float((p - aim).mean())
    p = 1 / (1 + np.exp(-(slope * raw + shift)))
    limits = []
    for g in range(len(GENERATORS)):
        own = held[:, 1] == g
        good = [t for t in np.unique(np.floor(p[own] * 1000) / 1000) if t >= 0.5 and (own & (p >= t)).any() and held[own & (p >= t), 0].mean() >= PRECISION]
        limits.append(round(float(min(good, default=1.01)), 3))
    return prior, tuple(trees), (round(slope, 6), round(shift, 6)), tuple(limits)


def probability(model, feature: dict[str, Column]) -> Column:
    """The calibrated probability as a column: the trees as nested conditions."""
    prior, trees, (slope, shift), _ = model
    names = list(feature)

    def tree(t) -> Column:
        return F.when(feature[names[t[0]]] <= t[1], tree(t[2])).otherwise(tree(t[3])) if isinstance(t, tuple) else F.lit(t)

    raw = reduce(lambda a, b: a + b, [tree(t) for t in trees], F.lit(prior))
    return 1 / (1 + F.exp(-(raw * slope + shift)))


def _free(found: Column, base: Column) -> Column:
    """The candidates (in order of their starts) that lie in no base span: one sweep with the furthest end of the base spans so far."""
    marks = F.sort_array(F.concat(
        F.transform(base, lambda b: F.struct(b["start"].alias("start"), F.lit(-1).alias("i"), b["end"].alias("end"))),
        F.transform(found, lambda c, i: F.struct(c["start"].alias("start"), i.alias("i"), c["end"].alias("end")))))
    zero = F.struct(F.lit(0).alias("reach"), F.array().cast("array<int>").alias("out"))
    kept = F.aggregate(
        marks, zero,
        lambda a, x: F.struct(
            F.when(x["i"] < 0, F.greatest(a["reach"], x["end"])).otherwise(a["reach"]).alias("reach"),
            F.when((x["i"] < 0) | (x["end"] <= a["reach"]), a["out"]).otherwise(F.concat(a["out"], F.array(x["i"]))).alias("out")),
        lambda a: a["out"])
    return F.transform(kept, lambda i: F.get(found, i))


_TAKEN = "array<struct<start:int,generator:int,end:int,p:double>>"


def _chosen(model, text: Column, base: Column) -> Column:
    """Spans (start, kind, end) of the candidates that the trees choose, apart from base spans and better candidates."""
    limit = lambda g: reduce(lambda a, b: a.when(g == b[0], b[1]), enumerate(model[3]), F.when(F.lit(False), 2.0)).otherwise(2.0)
    free = _let(candidates(text), lambda found: F.when(F.size(found) > 0, _free(found, base)).otherwise(found))
    described = F.transform(free, lambda c: F.struct(c["start"].alias("start"), c["generator"].alias("generator"), c["end"].alias("end"), F.struct(*[v.alias(n) for n, v in features(c).items()]).alias("f")))
    scored = F.transform(described, lambda c: F.struct(
        c["start"].alias("start"), c["generator"].alias("generator"), c["end"].alias("end"), probability(model, {n: c["f"][n] for n in FEATURES}).alias("p")))
    taken = F.filter(scored, lambda c: c["p"] >= limit(c["generator"]))

    def step(a: Column, c: Column) -> Column:
        last = F.try_element_at(a, F.lit(-1))
        meets = c["start"] < last["end"]
        return F.when(F.size(a) == 0, F.array(c)).when(~meets, F.concat(a, F.array(c))).when(
            c["p"] > last["p"], F.concat(F.slice(a, 1, F.size(a) - 1), F.array(c))).otherwise(a)

    apart = _let(taken, lambda t: F.when(F.size(t) > 1, F.aggregate(t, F.array().cast(_TAKEN), step)).otherwise(t))
    kind = lambda g: F.get(F.array(*[F.lit(k) for k, _ in GENERATORS]), g)
    return F.transform(apart, lambda c: F.struct(c["start"].alias("start"), kind(c["generator"]).alias("kind"), c["end"].alias("end")))


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, spans): sorted arrays of (start, kind, end); ``spans`` holds the base spans and the chosen ones."""
    model = _trained(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    plain = docs.select(F.col(id_col).alias("__id"), text.alias("__text"))
    based = plain.withColumn("__base", base_spans(F.col("__text")))
    both = _let(F.col("__base"), lambda b: F.struct(b.alias("base"), F.sort_array(F.concat(b, _chosen(model, F.col("__text"), b))).alias("spans")))
    return based.select(F.col("__id").alias(id_col), both.alias("__both")).select(id_col, "__both.base", "__both.spans")


def written(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with every span replaced by its kind in angle brackets; overlapping spans share the first one's."""
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    done = F.aggregate(
        spans, zero,
        lambda a, x: F.struct(
            F.greatest(a["at"], x["end"]).alias("at"),
            F.when(x["start"] < a["at"], a["out"]).otherwise(
                F.concat(a["out"], F.array(F.substring(text, a["at"] + 1, x["start"] - a["at"]), F.get(names, x["kind"])))).alias("out")),
        lambda a: F.concat(F.array_join(a["out"], ""), F.substring(text, a["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)


def redact(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """``docs`` with the spans of each text replaced; a length column, if there is one, is counted anew. Rows and columns stay as they are."""
    model = _trained(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    spans = _let(base_spans(text), lambda b: F.sort_array(F.concat(b, _chosen(model, text, b))))
    new = F.when(F.col(text_col).isNotNull(), _let(spans, lambda s: redacted(text, s)))
    out = docs.withColumn(text_col, new)
    return out.withColumn(length_col, F.length(text_col).cast(docs.schema[length_col].dataType)) if length_col in docs.columns else out
