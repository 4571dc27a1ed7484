"""Line dedup, near-duplicates, repeated passages and the pipeline."""

from __future__ import annotations

import math
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from oreflow.llm import line_dedup, near_dedup, packing, quality, queries, repeats
from oreflow.llm.frames import table
from oreflow.llm.run_index import RunIndex
from tests.llm import brute
from verification.compare import compare

SF = "/root/testdata/sf0.001"
EDGES = [(None, None), (1, ""), (2, None), (3, " \n "), (4, "é" * 300), (5, "é" * 300), (6, "a\nb\na\nb")]


def _frame(spark, rows, more=""):
    return spark.createDataFrame(rows, "doc_id long, text string" + more).repartition(3)


@pytest.mark.parametrize("run", [1, 2, 3, 5])
def test_line_runs(spark, run):
    rng = random.Random(run)
    rows = [(i, "\n".join(rng.choice(["a", "b", "c", "", " ", "long line"]) for _ in range(rng.randint(0, 9))))
            for i in range(40)] + [(None, "a\nb\nc\na\nb"), (41, None)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_lines int")
    out = line_dedup.dedup_lines(df, run=run).select("doc_id", "n_lines", "n_removed", "text").collect()
    assert {r[0]: tuple(r)[1:] for r in out} == brute.line_dedup(rows, run)
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0


@pytest.mark.parametrize("least", [1, 4, 60])
def test_single_lines_from_a_least_length_on(spark, least):
    rng = random.Random(least)
    lines = ["a", "éé", "four", "  five ", "x" * 59, "é" * 60, "y" * 61, "", " " * 70]
    rows = [(i, "\n".join(rng.choice([*lines, f"own {i} {rng.random()}"]) for _ in range(rng.randint(0, 7))))
            for i in range(50)] + [(None, "\n".join(["y" * 61] * 3)), (51, None)]
    out = line_dedup.dedup_lines(_frame(spark, rows), least_chars=least).select(
        "doc_id", "n_lines", "n_removed", "text").collect()
    assert {r[0]: tuple(r)[1:] for r in out} == brute.line_dedup(rows, 2, least)


def test_line_runs_of_repeated_rows(spark):
    out = line_dedup.dedup_lines(_frame(spark, [(1, "a\nb")] * 3 + [(2, "a\nb\nc")])).collect()
    assert sorted((r["doc_id"], r["text"]) for r in out) == [(1, "a\nb")] * 3 + [(2, "c")]


def _edited(rng, words, share):
    return " ".join(rng.choice("xyz") + str(rng.random()) if rng.random() < share else w for w in words)


def test_near_duplicates(spark):
    rng = random.Random(8)
    rows = []
    for g in range(12):
        base = [f"w{g}{rng.randint(0, 400)}" for _ in range(rng.randint(3, 120))]
        rows += [_edited(rng, base, rng.choice([0, 0.005, 0.02, 0.05])) for _ in range(rng.choice([1, 3, 25]))]
    rows = list(enumerate([*rows, "A b C d e f", "a B c D e F", "one two", "ONE two", "", None, "  "]))
    out = near_dedup.near_duplicates(_frame(spark, [(k, t, 1) for k, t in rows], ", n_shingles int")).collect()
    expected = brute.near_duplicates(rows)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out} == expected
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in out)


def test_near_duplicates_of_odd_rows(spark):
    text = "a b c d e f g"
    out = near_dedup.near_duplicates(_frame(spark, [(None, text), (4, text), (2, text), (2, text), (9, None)]))
    assert sorted(map(str, (tuple(r) for r in out.collect()))) == sorted(map(str, [
        (None, 3, None, True), (4, 3, 2, False), (2, 3, 2, True), (2, 3, 2, True), (9, 0, 9, True)]))
    assert near_dedup.near_duplicates(_frame(spark, [(1, "x")]).limit(0)).count() == 0


def test_two_texts_under_one_key(spark):
    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    rows = [(7, a), (7, b), (3, a + " more"), (7, b), (9, b + " more")]
    out = near_dedup.near_duplicates(_frame(spark, rows)).collect()
    assert sorted(tuple(r) for r in out) == [
        (3, 57, 3, True), (7, 56, 3, False), (7, 56, 7, True), (7, 56, 7, True), (9, 57, 7, False)]
    columns = [(k, t, i) for i, (k, t) in enumerate([*rows, (None, a), (None, a), (5, None), (5, None), (6, "")])]
    docs = _frame(spark, columns, ", component long")
    kept = near_dedup.distinct_documents(docs)
    assert kept.columns == docs.columns
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in kept.collect()))) == sorted(map(str, [
        (3, a + " more"), (7, b), (None, a), (None, a), (5, None), (5, None), (6, "")]))
    assert near_dedup.distinct_documents(docs.limit(0)).count() == 0


@pytest.mark.parametrize("percent", [60, 80, 85, 95])
def test_bounds_lose_no_pair(spark, percent):
    """Candidates of the prefix filter against all pairs, over small and mixed sets."""
    import numpy as np

    rng = random.Random(percent)
    bases = [[rng.getrandbits(63) for _ in range(n)] for n in (1, 2, 5, 20, 20, 60, 200)]
    sets = []
    for k in range(160):
        base = rng.choice(bases)
        share = rng.choice([0, 0.02, 0.05, 0.1, 0.2])
        own = {x for x in base if rng.random() >= share} | {rng.getrandbits(63) for _ in range(rng.randint(0, max(1, len(base) // 9)))}
        sets.append(np.unique(np.array(sorted(own), np.uint64)))
    df = spark.createDataFrame([
        (k, k % 150, len(x), near_dedup.bitmap(x).tolist(), x.view(np.int64).tolist()) for k, x in enumerate(sets) if len(x)],
        "node long, component long, n long, bits array<long>, tokens array<long>")
    found = {(r["a"], r["b"]) for r in near_dedup._candidates(df, percent).collect()}
    links = {(a, b) for b in range(len(sets)) for a in range(b)
             if a % 150 != b % 150 and near_dedup._similar(sets[a], sets[b], percent) and len(sets[a])}
    assert links and links <= found and len(found) <= 2 * len(links) + 40


def test_links_that_the_smallest_member_does_not_show(spark):
    # Each text shares most words with the next one only: a chain.
    words = [f"w{i}" for i in range(700)]
    rows = [(k, " ".join(words[8 * k:8 * k + 300])) for k in range(20)]
    out = near_dedup.near_duplicates(_frame(spark, rows)).collect()
    expected = brute.near_duplicates(rows)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out} == expected
    assert {c for _, c in expected.values()} == {0}


def test_links_in_a_template_group_below_the_threshold(spark, monkeypatch):
    # All texts are 0.81 to 0.84 to each other; planted ones are linked.
    rng = random.Random(5)
    template = [f"t{i}" for i in range(400)]

    def own(k):
        return [f"{k}x{i}" for i in range(42)]

    rows, linked = [], 60
    for k in range(300):
        mine = own(k)
        rows.append((k, " ".join(template + mine)))
        if k < linked:
            rows.append((1000 + rng.randint(0, 10 ** 6) * 100 + k, " ".join(template + mine[:12] + [f"{k}y{i}" for i in range(30)])))
    rng.shuffle(rows)
    found, candidates = [], near_dedup._candidates
    monkeypatch.setattr(near_dedup, "_candidates", lambda *a: found.append(candidates(*a)) or found[0])
    out = near_dedup.near_duplicates(_frame(spark, rows)).collect()
    expected = brute.near_duplicates(rows)
    assert len({c for _, c in expected.values()}) == 300
    assert found[0].count() <= len(rows)  # not the 64,620 pairs of the group
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out} == expected


def test_matching_statistics():
    rng = random.Random(1)
    for _ in range(60):
        letters = rng.choice([b"ab", b"abcd", bytes(range(256))])
        texts = [bytes(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(0, 5))]
        patterns = [bytes(rng.choice(letters + b"z") for _ in range(rng.randint(0, 25))) for _ in range(4)]
        patterns += [t[2:20] for t in texts]
        index = RunIndex(texts)
        lengths, places = index.matching(patterns)
        for i, p in enumerate(patterns):
            for j in range(len(p)):
                longest = max((k for k in range(len(p) - j + 1) if any(p[j:j + k] in t for t in texts)), default=0)
                column = len(p) - 1 - j
                assert lengths[i, column] == longest
                if longest:
                    at = places[i, column]
                    assert bytes((index.text[at:at + longest] - 1).astype("u1")) == p[j:j + longest]


@pytest.mark.parametrize("seed", [0, 1])
def test_repeated_passages(spark, seed):
    rng = random.Random(seed)
    pool = ["".join(rng.choice("abcd é ") for _ in range(rng.randint(60, 400))) for _ in range(12)]
    parts = [lambda: rng.choice(pool), lambda: rng.choice(pool)[rng.randint(0, 50):],
             lambda: "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(0, 200))),
             lambda: "xy" * rng.randint(0, 120)]
    rows = [(k, "".join(rng.choice(parts)() for _ in range(rng.randint(0, 6))))
            for k in rng.sample(range(-500, 500), 60)]
    rows += [(900, "\n" * 99), (901, "q" * 100), (902, "q" * 250)]
    out = repeats.remove_repeats(_frame(spark, [(*r, 1) for r in rows], ", n_bytes int")).collect()
    got = {r["row"]["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in out}
    assert got == brute.repeats(rows)


def test_repeated_passages_of_odd_rows(spark):
    text = "".join(random.Random(1).choices("abcdefghij", k=150))
    out = repeats.remove_repeats(_frame(spark, [(1, text)] * 2 + [(None, text), (3, None), (3, "")])).collect()
    assert sorted((str(r["row"]["doc_id"]), r["n_bytes"], r["n_removed"]) for r in out) == [
        ("1", 150, 150), ("1", 150, 150), ("3", 0, 0), ("3", 0, 0), ("None", 150, 0)]
    assert repeats.remove_repeats(_frame(spark, [(1, text)]).limit(0)).count() == 0


def test_long_texts_are_taken_in_stretches(spark, monkeypatch):
    rng = random.Random(3)
    part = "".join(rng.choice("abcdefghij ") for _ in range(700))
    rows = [(1, part * 3), (2, "z" + part)]
    monkeypatch.setattr(repeats, "STRETCH", 600)
    import numpy as np

    found = repeats._anchors_of(np.array([1, 2]), np.array([0, 0], np.int32), [t.encode() for _, t in rows])
    seen = np.zeros(len(rows[0][1]) - 99, int)
    for r in found[found["doc"] == 1]:
        seen[r["start"]:r["start"] + r["more"] + 1] += 1
    assert (seen == 1).all()


def _met(texts):
    """Rows that the task of all anchors gives for one batch of texts."""
    n = len(texts)
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(n), pa.int64()), pa.array([0] * n, pa.int32()), pa.array(texts)], names=["doc", "tie", "text"])
    return [r for b in repeats._meet(repeats._find(1)(iter([batch]))) for r in b.to_pylist()]


def test_contexts_that_share_their_anchor_only_are_not_fetched():
    rng = random.Random(4)

    def own(k):
        return "".join(rng.choices("abcdefghij ", k=k))

    # Short strings that all texts share, and too little around them for a window.
    shared = [own(50) for _ in range(8)]
    texts = ["".join(own(120) + x for x in [*rng.sample(shared, 8), ""]) for _ in range(60)]
    found = repeats._anchors_of(*(np.zeros(60, t) for t in (np.int64, np.int32)), [t.encode() for t in texts])
    assert len(found) - len(np.unique(found["a"])) > 200
    assert [r for r in _met(texts) if r["kind"] == repeats.FETCH] == []
    # One passage as long as a window.
    passage = own(100)
    met = [r for r in _met([own(150) + passage + own(150) for _ in range(5)]) if r["kind"] == repeats.FETCH]
    assert {r["doc"] for r in met} == set(range(5))


@pytest.mark.parametrize("length", [99, 100, 101, 138])
def test_passages_about_as_long_as_a_window(spark, length):
    rng = random.Random(length)
    pool = ["".join(rng.choices("abcdé fgh", k=length + 30)) for _ in range(30)]

    def piece():
        data = rng.choice(pool)
        at = rng.randint(0, 30)
        return data[at:at + length] if rng.random() < 0.7 else "".join(rng.choices("abcdé fgh", k=rng.randint(0, 90)))

    rows = [(k, "".join(piece() for _ in range(rng.randint(1, 5)))) for k in range(150)]
    out = repeats.remove_repeats(_frame(spark, rows)).collect()
    got = {r["row"]["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in out}
    assert got == brute.repeats(rows)


def test_texts_are_shuffled_once_and_blobs_follow_tasks(spark, monkeypatch):
    parts, find = [], repeats._find
    monkeypatch.setattr(repeats, "_find", lambda n: parts.append(n) or find(n))
    rows = [(k, f"{k} " * 40 + "".join(random.Random(k % 9).choices("abcdefghij", k=150))) for k in range(30)]
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = _frame(spark, rows)
        out = repeats.remove_repeats(docs)
        assert sum(r["n_removed"] >= 150 for r in out.collect()) >= 21
        assert "ReusedExchange" in out._jdf.queryExecution().executedPlan().toString()
        # Each batch sends a blob to a part at most: as many parts as tasks.
        assert parts == [4 * docs.rdd.getNumPartitions()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    assert compare(spark, con, name, queries.queries()[name], queries.oracle_sql()[name], SF) is None


def _pipeline_by_hand(spark, docs):
    """Rows of all stages but the last, by the plain versions."""
    rules = quality.learned(table(spark, SF, "documents"), table(spark, SF, "labels"))
    rows = []
    for key, text in docs:
        n_words, chars, symbols, lines, repeated = brute.quality_counts(text)
        values = {"n_words": n_words, "chars_per_word": chars / max(n_words, 1),
                  "symbols_per_char": symbols / max(chars, 1),
                  "dup_lines_per_word": lines / max(n_words, 1), "repeated_words": repeated / max(n_words, 1)}
        hit = any(all((values[c.feature] >= c.threshold) if c.above else (values[c.feature] <= c.threshold)
                      for c in rule) for rule in rules)
        if n_words >= 10 and 100 * repeated <= 20 * n_words and not hit:
            rows.append((key, text))
    cut = brute.line_dedup(rows)
    rows = [(k, cut[k][2]) for k, _ in rows if brute.words(cut[k][2])]
    kept = brute.near_duplicates(rows, 80)
    rows = [(k, t) for k, t in rows if kept[k][1] == k]
    left = {k: x[3].decode("utf-8", "ignore") for k, x in brute.repeats(rows).items()}
    return {k: t for k, t in left.items() if brute.words(t)}


def test_pipeline_equals_its_plain_version(spark):
    docs = table(spark, SF, "documents")
    expected = _pipeline_by_hand(spark, [tuple(r) for r in docs.select("doc_id", "text").collect()])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        columns = docs.columns
        docs = queries.cut(stage(spark, docs, SF))
        assert docs.columns == columns
    assert {r["doc_id"]: r["text"] for r in docs.collect()} == expected
    packed = corpus_pipeline.run(spark, SF).collect()
    sizes = packing.pieces(docs, queries.public_tokenizers.path("word_bpe_49k.json")).select(
        "doc_id", "piece", "length", "ids_crc32")
    assert sorted((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in packed) == sorted(
        tuple(r) for r in sizes.collect())


def test_every_stage_takes_odd_rows_and_an_empty_table(spark):
    columns = table(spark, SF, "documents").schema
    rows = [(k, t, None, None, None) for k, t in EDGES] + [
        (7, "word " * 5000, "en", "s", 1), (8, "the quick brown fox jumps over a lazy dog and sleeps then", "en", "s", 1)]
    for content in (rows, [], [rows[-1]] * 2):
        docs = spark.createDataFrame(content, columns)
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            assert out.count() <= max(len(content) + 5, 0)


@pytest.mark.parametrize("percent", [80, 85])
def test_table_sizes_fit_the_threshold(percent):
    bands, alike = near_dedup.sizes(percent)
    like = percent / 100
    assert 2 * (1 - like ** 2) ** bands < 1e-4 < 2 * (1 - like ** 2) ** (bands - 1)
    n = 4 * bands
    assert sum(math.comb(n, k) * like ** k * (1 - like) ** (n - k) for k in range(alike)) < 1e-6
