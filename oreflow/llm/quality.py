"""Quality rules as a learned decision list, in DataFrame operations only.

Texts become a few counts. On a bounded sample of labelled rows, sequential
covering grows one rule after another: conjunctions of thresholds that gain
most on the low-quality rows not covered yet. Each rule is pruned on rows that
did not grow it and kept only where it is precise there. The list is applied as
one ordered conditional expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.llm.frames import once, words_of

#: Labelled rows a list is learned from, at most: those with the smallest hashes.
SAMPLE_ROWS = 20_000
WINDOW = 5
SYMBOLS, BLANKS = "#*$%&|<>", " \t\n\x0b\x0c\r"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

#: What rules look at; all from the counts.
FEATURES: dict[str, str] = {
    "n_words": "cast(n_words as double)",
    "chars_per_word": "word_chars / greatest(n_words, 1)",
    "symbols_per_char": "n_symbols / greatest(word_chars, 1)",
    "dup_lines_per_word": "n_dup_lines / greatest(n_words, 1)",
    "repeated_words": "n_repeat_words / greatest(n_words, 1)",
}


def _longer_without(text: Column, characters: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


def counted(docs: DataFrame, text: str = "text") -> DataFrame:
    """(row, the five counts): ``row`` is a struct of all columns of ``docs``.

    n_words and word_chars count words between ASCII white space and their
    characters; n_symbols the characters of SYMBOLS; n_dup_lines the lines with
    a word that equal an earlier one; n_repeat_words the words inside 5-word
    windows found twice or more. Null texts count as empty; an empty table
    gives no rows. Nothing is shuffled.
    """
    value = F.col("value")
    lines = F.filter(F.split(value, "\n"), lambda x: F.translate(x, BLANKS, "") != "")
    own = docs.select(F.struct("*").alias("row"), F.coalesce(text, F.lit("")).alias("value"))
    base = once(own, lines=lines, words=words_of(value))
    hashed = base.select(
        "row",
        (F.length("value") - _longer_without(value, BLANKS)).cast("long").alias("word_chars"),
        _longer_without(value, SYMBOLS).alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("words").cast("long").alias("n_words"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("h0"))
    hashed = once(hashed, h=F.col("h0")).drop("h0")
    starts = F.sequence(F.lit(0), F.size("h") - WINDOW)
    windows = F.when(F.size("h") >= WINDOW, F.transform(starts, lambda i: F.xxhash64(
        *[F.get("h", i + k) for k in range(WINDOW)]))).otherwise(F.array().cast("array<bigint>"))
    windowed = once(hashed, g=windows).drop("h")
    repeats = F.size(F.array_distinct("g")) < F.size("g")
    spots = F.when(repeats, F.sort_array(F.transform("g", lambda x, i: F.struct(
        x.alias("x"), i.alias("i"))))).otherwise(F.array().cast("array<struct<x:bigint,i:int>>"))
    sorted_ = once(windowed, s=spots).drop("g")
    twice = F.filter("s", lambda e, i: F.coalesce(e.x == F.get("s", i - 1).x, F.lit(False))
                     | F.coalesce(e.x == F.get("s", i + 1).x, F.lit(False)))
    placed = once(sorted_, p=F.sort_array(F.transform(twice, lambda e: e.i))).drop("s")
    covered = F.aggregate(
        F.transform("p", lambda p, i: F.least(
            F.lit(WINDOW), F.coalesce(F.get("p", i + 1) - p, F.lit(WINDOW)))),
        F.lit(0), lambda a, x: a + x)
    return placed.select(
        "row", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        covered.cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.expr(FEATURES[self.feature])
        return value >= self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<='} {self.threshold:g}"


Rule = tuple[Condition, ...]


def learn(labelled: DataFrame, label: str = "quality", sample_rows: int = SAMPLE_ROWS,
          rules: int = 8, depth: int = 3, cuts: int = 24, precision: float = 0.9,
          least: int = 5) -> list[Rule]:
    """Ordered rules, each of which rejects what it matches.

    ``labelled`` has the counts and the label, 0 for low quality. Rows without
    a label are left out. Without low-quality rows there are no rules.
    """
    rows = (
        labelled.where(F.col(label).isNotNull() & ~base_failed())
        .select(*[F.expr(e).alias(f) for f, e in FEATURES.items()], F.col(label).alias("label"),
                F.xxhash64(*COUNTS, label).alias("order"))
        .orderBy("order", *FEATURES).limit(sample_rows).collect())
    if not rows:
        return []
    everything = (1 << len(rows)) - 1
    low = _bits(r["label"] == 0 for r in rows)
    held_out = _bits(i % 3 == 2 for i in range(len(rows)))
    grow = everything & ~held_out
    found: list[Rule] = []
    left = everything
    while len(found) < rules:
        rule, masks = _grown(_options(rows, left & low, cuts), grow & left, low, depth)
        rule, matched = _pruned(rule, masks, held_out & left, low, everything)
        hits = (matched & left & low).bit_count()
        good = all(
            (matched & part & low).bit_count() >= precision * (matched & part).bit_count()
            for part in (grow & left, held_out & left))
        if not rule or not good or hits < least:
            break
        found.append(rule)
        left &= ~matched
    return found


def _options(rows, wanted: int, cuts: int) -> list[tuple[Condition, int]]:
    """Thresholds at the values of the wanted rows, with the rows each one matches."""
    options = []
    for feature in FEATURES:
        values = [r[feature] for r in rows]
        ranked = sorted({v for i, v in enumerate(values) if wanted >> i & 1})
        for t in ranked[::max(1, len(ranked) // cuts)] + ranked[-1:]:
            options.append((Condition(feature, True, t), _bits(v >= t for v in values)))
            options.append((Condition(feature, False, t), _bits(v <= t for v in values)))
    return options


def _bits(flags) -> int:
    return int("".join("1" if f else "0" for f in flags)[::-1] or "0", 2)


def _grown(options, rows: int, low: int, depth: int):
    """Conditions added as long as they gain information on the low-quality rows."""
    rule, masks = [], []
    while len(rule) < depth:
        p, n = (rows & low).bit_count(), (rows & ~low).bit_count()
        if not p or not n:
            break
        before, best = math.log2(p / (p + n)), (0.0, None, 0)
        for condition, mask in options:
            inside = rows & mask
            hit = (inside & low).bit_count()
            if not hit:
                continue
            gain = hit * (math.log2(hit / inside.bit_count()) - before)
            if gain > best[0] + 1e-9:
                best = (gain, condition, mask)
        if best[1] is None:
            break
        rule.append(best[1])
        masks.append(best[2])
        rows &= best[2]
    return rule, masks


def _pruned(rule, masks, rows: int, low: int, everything: int) -> tuple[Rule, int]:
    """The leading part of a rule that is best on rows held out from growing."""
    best, kept, matched = -2.0, 0, 0
    inside = everything
    for i, mask in enumerate(masks):
        inside &= mask
        p, n = (inside & rows & low).bit_count(), (inside & rows & ~low).bit_count()
        worth = (p - n) / (p + n) if p + n else -1.0
        if worth > best + 1e-12:
            best, kept, matched = worth, i + 1, inside
    return tuple(rule[:kept]), matched


def verdict(rules: list[Rule]) -> Column:
    """Number of the first rule that matches, from 1; 0 where none does."""
    out = None
    for i, rule in enumerate(rules, 1):
        both = rule[0].column()
        for condition in rule[1:]:
            both = both & condition.column()
        out = F.when(both, i) if out is None else out.when(both, i)
    return F.lit(0) if out is None else out.otherwise(0)


def learned(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
            sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules from the labelled rows of ``docs``.

    Of the labels, the ``sample_rows`` with the smallest key hashes are taken,
    so what is broadcast is bounded by that number. Labels without a key or a
    quality don't count; repeated ones count once, as the lowest.
    """
    known = labels.where(F.col(key).isNotNull() & F.col("quality").isNotNull()).groupBy(key).agg(
        F.min("quality").alias("quality"))
    sample = known.orderBy(F.xxhash64(key), key).limit(sample_rows).toDF("label_key", "label")
    rows = docs.select(F.col(key).alias("label_key"), text).join(F.broadcast(sample), "label_key")
    return learn(counted(rows, text).withColumn("label", F.col("row.label")), "label", sample_rows)


def judged(docs: DataFrame, rules: list[Rule], text: str = "text") -> DataFrame:
    """``counted`` with base_failed, rule (0: none matches) and kept."""
    marked = counted(docs, text).withColumn("base_failed", base_failed()).withColumn(
        "rule", verdict(rules))
    return marked.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))
