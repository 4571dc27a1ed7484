"""Spelling variants: words one edit apart, found by asymmetric q-chunks.

A word cut into two disjoint chunks keeps one of them through any single edit.
So one side of a pair contributes its two chunks, the other its positional
grams: the pieces of the same size whose place is within a shift of one of a
chunk's. The longer word, or the smaller of two equally long ones, is the
chunked side; a missing letter then shifts the second chunk by one, and nothing
else shifts. Pairs that meet are verified by their edit distance.

A chunk may be common. Where too many words meet on one, the rest of the word
is cut in two chunks again, of which again one is kept, and so on down to
single letters. Then a key holds only words that differ in that letter, which
are all pairs to be found. So candidates stay in proportion to words and links.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.llm.frames import cut

LETTERS = r"A-Za-zÀ-ÿ"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: A key is joined if that makes at most so many pairs for each of its rows.
PAIRS_A_ROW = 32


def lowered(run: Column) -> Column:
    """``run`` with A-Z in lower case and every other letter as it is."""
    plain = F.octet_length(run) == F.char_length(run)
    return F.when(plain, F.lower(run)).otherwise(F.translate(run, _UPPER, _UPPER.lower()))


def runs(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = 1) -> DataFrame:
    """(key, run): every maximal run of at least ``least`` letters, lowered.

    Null and empty texts have none; repeated rows count each.
    """
    found = F.regexp_extract_all(F.col(text), F.lit(f"[{LETTERS}]{{{least},}}"), F.lit(0))
    return docs.select(F.col(key).alias("key"), F.explode(found).alias("run")).select(
        "key", lowered(F.col("run")).alias("run"))


def vocabulary(words: Column, found: DataFrame, least_letters: int = 6, least_n: int = 5) -> DataFrame:
    """(word, n): the words of ``found`` that are long and frequent enough."""
    return found.select(words.alias("word")).where(
        F.char_length("word") >= least_letters).groupBy("word").agg(
        F.count("*").alias("n")).where(F.col("n") >= least_n)


def _halves(rows: DataFrame) -> DataFrame:
    """Rows once for each chunk that may be kept; the rest, [low, high), stays open."""
    middle = (F.col("low") + F.floor((F.col("high") - F.col("low")) / 2)).cast("int")
    rest = F.explode(F.array(
        F.struct(middle.alias("low"), F.col("high")), F.struct(F.col("low"), middle.alias("high"))))
    return rows.withColumn("rest", rest).select(
        "word", "n", "length", "shift", "chunked", "rest.low", "rest.high")


def near_pairs(words: DataFrame, pairs_a_row: int = PAIRS_A_ROW) -> DataFrame:
    """(a, a_n, b, b_n): unordered pairs exactly one edit apart, each once.

    ``words`` has distinct words and n.
    """
    size = F.char_length("word")

    def side(length: Column, shift: int, chunked: bool) -> Column:
        return F.struct(length.alias("length"), F.lit(shift).alias("shift"),
                        F.lit(chunked).alias("chunked"))

    # Grams of a word meet chunks of words as long, and of words one letter longer.
    sides = F.array(side(size, 0, True), side(size, 0, False), side(size + 1, 1, False))
    rows = words.select("word", "n", F.explode(sides).alias("x")).select("word", "n", "x.*")
    rows = rows.select("*", F.lit(0).alias("low"), F.col("length").alias("high"))
    found = []
    while True:
        ahead = F.substr("word", F.lit(1), F.col("low"))
        behind = F.substr("word", F.col("high") - F.col("shift") + 1)
        keyed = cut(_halves(rows).withColumn(
            "key", F.xxhash64("length", "low", "high", ahead, F.lit(0), behind)))
        name, chunks, grams = F.xxhash64("word"), F.count_if("chunked"), F.count_if(~F.col("chunked"))
        few = chunks * grams <= pairs_a_row * F.count("*")
        keys = cut(keyed.groupBy("key").agg(
            F.min(name).alias("least"), F.max(name).alias("most"),
            (few | (F.max(F.col("high") - F.col("low")) <= 1)).alias("few")).where(
            "least < most").select("key", "few"))
        met = keyed.join(keys.where("few").select("key"), "key")
        one = met.where("chunked").select("key", F.col("word").alias("a"), F.col("n").alias("a_n"))
        other = met.where("not chunked").select(
            "key", "shift", F.col("word").alias("b"), F.col("n").alias("b_n"))
        found.append(cut(one.join(other, "key").where("shift = 1 or a < b").where(
            F.levenshtein("a", "b", 1) == 1).select("a", "a_n", "b", "b_n").distinct()))
        many = keys.where("not few").select("key")
        if many.isEmpty():
            return reduce(DataFrame.unionByName, found).distinct()
        rows = keyed.join(many, "key").drop("key")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of the chain of forms, for words that have a form.

    Each round doubles the links followed, so chains of 2^k links take k rounds.
    """
    chain = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = chain.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        longer = cut(chain.join(ahead, "root", "left").select(
            "word", F.coalesce("ahead", "root").alias("root"), F.col("ahead").isNotNull().alias("moved")))
        chain = longer.drop("moved")
        if longer.where("moved").isEmpty():
            return chain


def variants(words: DataFrame, ratio: int = 5, pairs_a_row: int = PAIRS_A_ROW) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of (word, n).

    A word's form is its most frequent near word (ties: the first in code-point
    order) if that occurs at least ``ratio`` times as often; root follows the
    forms to the last. Forms and form_n are null without one, root is then the
    word itself. Words must be distinct and not null; n may not be null. A ratio
    above 1 keeps chains from closing. An empty table gives no rows.
    """
    words = cut(words.select("word", "n"))
    pairs = near_pairs(words, pairs_a_row)
    back = pairs.select(F.col("b").alias("a"), F.col("b_n").alias("a_n"),
                        F.col("a").alias("b"), F.col("a_n").alias("b_n"))
    best = pairs.unionByName(back).groupBy(F.col("a").alias("word")).agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("b_n")).alias("n"), "b")).alias("best"))
    often = -F.col("best.n")
    fits = often >= ratio * F.col("n")
    formed = cut(words.join(best, "word", "left").select(
        "word", F.when(fits, F.col("best.b")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(fits, often).cast("long").alias("form_n")))
    roots = _roots(formed.where("form is not null"))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def with_slips(one_in: int = 199) -> Column:
    """Words of (key, run), of which one in ``one_in`` lost a letter.

    The slip depends on key and run alone; a null key counts as empty.
    """
    h = F.crc32(F.concat(F.coalesce(F.col("key").cast("string"), F.lit("")), F.lit(":"),
                         F.col("run")).cast("binary"))
    at = (h % F.char_length("run")).cast("int")
    return F.when(h % one_in == 0, F.concat(
        F.substr("run", F.lit(1), at), F.substr("run", at + 2))).otherwise(F.col("run"))
