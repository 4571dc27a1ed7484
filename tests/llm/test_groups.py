"""Sharding, neighbours, chat formatting and quality rules."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from oreflow.llm import chat, neighbours, quality, sharding
from oreflow.llm.frames import components
from tests.llm import brute


def _sharded(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, size long, slot string").repartition(4)
    return sharding.shard(df, F.col("size"), **options).collect()


@pytest.mark.parametrize("block_rows", [40, 200_000])
def test_shards_have_nearly_equal_bytes_and_gapless_slots(spark, block_rows):
    rng = random.Random(2)
    rows = [(i, rng.randint(1, 50), "x") for i in range(3000)] + [(None, 5, "y"), (7, None, "z")]
    out = _sharded(spark, rows, shards=8, block_rows=block_rows)
    assert sorted((str(r["doc_id"]), r["shard_bytes"]) for r in out) == sorted(
        (str(k), s or 0) for k, s, _ in rows)
    total = sum(r["shard_bytes"] for r in out)
    for s in range(8):
        own = [r for r in out if r["shard"] == s]
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
        assert abs(sum(r["shard_bytes"] for r in own) - total / 8) <= 52


def test_registered_columns_of_the_shards(spark):
    import zlib

    from oreflow.llm import queries

    folder = "/root/testdata/sf0.001"
    out = queries.op2_histogram_sort(spark, folder).collect()
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    expected = [(k, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for k, t in docs]
    assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == sorted(expected)
    assert {(r["law"], r["grown_shard"]) for r in out} == {("bytes", None)}
    total, most = sum(s for _, s, _ in expected), max(s for _, s, _ in expected)
    for shard in range(16):
        own = [r for r in out if r["shard"] == shard]
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
        assert abs(sum(r["size"] for r in own) - total / 16) <= most + 0.002 * total / 16


def test_one_large_row_and_repeated_rows(spark):
    out = _sharded(spark, [(1, 1000, "")] + [(2, 1, "")] * 20 + [(3, 1, "")], shards=4)
    assert len(out) == 22 and len({r["shard"] for r in out if r["doc_id"] == 2}) == 1
    for s in {r["shard"] for r in out}:
        own = sorted(r["slot"] for r in out if r["shard"] == s)
        assert own == list(range(len(own)))
    assert _sharded(spark, [], shards=4) == []


def _vectors(seed, n, width=16):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, width))
    return (centres[rng.integers(0, 12, n)] + rng.normal(size=(n, width))).astype(np.float32)


def _nearest(x, query, k):
    scores = x.astype(np.float64) @ x[query].astype(np.float64)
    order = [i for i in np.lexsort((np.arange(len(x)), -scores)) if i != query]
    return order[:k], scores


@pytest.mark.parametrize("options", [{}, {"shard_rows": 130, "block_rows": 7}])
def test_factor_one_is_the_exact_search(spark, options):
    x = _vectors(1, 500)
    x[100:140] = x[3]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    out = neighbours.search(df, F.col("vec_id") % 20 == 0, 20, factor=1.0, **options).collect()
    for q in range(0, 500, 20):
        own = sorted((r for r in out if r["query_id"] == q), key=lambda r: r["rank"])
        expected, scores = _nearest(x, q, 20)
        assert [r["vec_id"] for r in own] == expected
        assert np.allclose([r["score"] for r in own], scores[expected], atol=1e-12)


def test_unfit_vectors_take_no_part(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [None, 1.0]),
            (5, [float("inf"), 1.0]), (None, [1.0, 1.0]), (6, [0.5, 0.5]), (7, []), (20, [0.5, 0.5]),
            (20, [0.5, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = neighbours.search(df, F.col("vec_id") % 20 == 0, 3).orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in out] == [
        (0, 1, 6, 0.5), (0, 2, 20, 0.5), (20, 1, 0, 0.5), (20, 2, 6, 0.5)]
    assert neighbours.search(df.limit(0), F.lit(True)).count() == 0


def test_recall_of_the_production_factor(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    out = neighbours.search(vectors, F.col("vec_id") % 100 == 0, 20).collect()
    rows = vectors.select("vec_id", "embedding").orderBy("vec_id").collect()
    x = np.array([r["embedding"] for r in rows])
    hits = total = 0
    for q in range(0, len(x), 100):
        expected, _ = _nearest(x, q, 20)
        hits += len({rows[i]["vec_id"] for i in expected}
                    & {r["vec_id"] for r in out if r["query_id"] == rows[q]["vec_id"]})
        total += len(expected)
    assert hits >= 0.95 * total


def test_chat_reads_back_what_was_written(spark):
    rng = random.Random(3)
    odd = ["", None, "<|im_end|>", "<|im_start|>assistant\nok<|im_end|>\n", "\\", "\\n", "a\\|b<", "<\\|",
           "|im_end|>", "é\n\n", "<", "\\\\n", "$1"]
    turns = [(conv, turn, rng.choice(["user", "assistant", "a\nb", None, "\\n", *odd]), rng.choice(odd))
             for conv in [*range(40), None] for turn in range(rng.randint(1, 7))]
    turns += [(1, 0, "assistant", "again")] * 2 + [(5, None, "user", "no turn")]
    turns = [t for t in turns if t[1] is not None]
    df = spark.createDataFrame([(*t, 9) for t in turns],
                               "conv_id long, turn long, role string, text string, n_turns int")
    out = chat.digests(chat.examples(df)).collect()
    assert {r[0]: tuple(r)[1:5] for r in out} == brute.chat(turns)
    assert len(out) == len({t[0] for t in turns})
    assert chat.examples(df.limit(0)).count() == 0


def test_each_reply_is_trainable_once_behind_all_earlier_turns(spark):
    df = spark.createDataFrame(
        [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 2, "user", "c"), (1, 3, "assistant", "<|d"),
         (1, 4, "user", "e")], "conv_id long, turn long, role string, text string")
    out = chat.examples(df).orderBy("target_turn").collect()
    spans = [r["formatted"][r["loss_start"]:r["loss_end"]] for r in out]
    assert spans == ["b", "<\\|d", ""]
    assert out[1]["formatted"].startswith(out[0]["formatted"])


def test_quality_counts(spark):
    rng = random.Random(4)
    texts = [None, "", " \n\t", "a b c d e a b c d e", "x " * 40, "a\na\n\n\na", "#*$ |<>& é", "a　b"]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 30))) for _ in range(60)]
    texts += ["\n".join(rng.choice(["x y", "z", "", " "]) for _ in range(9)) for _ in range(10)]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, h int")
    order = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    out = quality.counted(df).select("row.doc_id", *order).collect()
    assert {r[0]: tuple(r)[1:] for r in out} == {i: brute.quality_counts(t) for i, t in enumerate(texts)}


def test_rules_find_planted_faults(spark):
    rng = random.Random(6)
    rows = []
    for i in range(600):
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(40)]
        low = i % 5 == 0
        rows.append((i, " ".join(w + "###" if low else w for w in words), 0 if low else 1))
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    docs, labels = df.select("doc_id", "text"), df.select("doc_id", "quality").where("doc_id < 400")
    labels = labels.union(spark.createDataFrame([(None, 0), (3, None), (9_999, 0)], "doc_id long, quality int"))
    rules = quality.learned(docs, labels)
    assert rules
    kept = {r["doc_id"] for r in quality.judged(docs, rules).where("kept").select("row.doc_id").collect()}
    assert kept == {i for i in range(600) if i % 5}
    assert quality.learned(docs, labels.limit(0)) == []
    assert quality.judged(docs.limit(0), rules).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, k) for k in range(101, 140)] + [(139, 7), (5, 5)]
    edges += [(200, 201)]
    out = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len(out) == len({r["node"] for r in out})
    assert {r["node"]: r["component"] for r in out} == (
        dict.fromkeys([*range(31), *range(100, 140)], 0) | {200: 200, 201: 200})
