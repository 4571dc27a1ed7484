"""Token counts, byte-level BPE and packing."""

from __future__ import annotations

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from oreflow.llm import byte_bpe, packing, token_counts
from oreflow.llm.word_bpe import WordEncoder

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", "   ", "a", "\n\n x", "don't I'LL 'S  12ab3!? …— é ǅ İ ªµ×÷ ", "a<|endoftext|>b ﬁ",
       "ΣΑΣ x\x1cy \x85 a　b ​", "x" * 700, " " * 300 + "y", "日本語テキスト 12 мир"]


def _texts(n=60):
    rng = random.Random(5)
    return ODD + ["".join(rng.choice("abB' \n\t.,!19é́ß \x1d<|>ÿ ") for _ in range(rng.randint(0, 90)))
                  for _ in range(n)]


def _greedy(word, vocabulary):
    at = count = 0
    while at < len(word):
        for end in range(len(word), at, -1):
            if word[at:end] in vocabulary:
                at, count = end, count + 1
                break
        else:
            count += len(word[at].encode())
            at += 1
    return count


def test_longest_match_counts_as_greedy_pieces_would():
    rng = random.Random(1)
    for _ in range(200):
        vocabulary = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 5))) for _ in range(8)}
        automaton = token_counts.LongestMatch(vocabulary)
        for _ in range(20):
            word = "".join(rng.choice("abcdé") for _ in range(rng.randint(0, 12)))
            assert automaton.count(word) == _greedy(word, vocabulary)


def test_token_counts_of_rows(spark):
    rows = [(i, t) for i, t in enumerate(_texts())] + [(None, None), (3, "a b"), (3, "a b")]
    df = spark.createDataFrame([(k, t, 7) for k, t in rows], "doc_id long, text string, n_tokens int")
    vocabulary = set(token_counts.piece_vocabulary(PIECES))
    expected = sorted((str(k), len(t.encode().split()) if t else 0, sum(
        _greedy(token_counts.START + w.decode(), vocabulary) for w in (t or "").encode().split()))
        for k, t in rows)
    counted = token_counts.count_tokens(df, PIECES)
    assert sorted((str(r[0]), r[1], r[2]) for r in counted.collect()) == expected
    assert token_counts.count_tokens(df.limit(0), PIECES).count() == 0


@pytest.fixture(scope="module")
def library():
    import tiktoken

    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})


@pytest.mark.parametrize("chunk,overlap", [(5, 3), (16, 8), (64, 1), (1000, 20)])
def test_byte_bpe_as_the_library(spark, library, chunk, overlap):
    rows = [(i, t) for i, t in enumerate(_texts())] + [(None, None), (1, "  "), (0, "x y")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    encoded = byte_bpe.encode(df, RANKS, public_tokenizers.PATTERN, chunk=chunk, overlap=overlap)
    back = byte_bpe.decode(encoded, RANKS, public_tokenizers.PATTERN).collect()
    assert sorted((str(r[0]), bytes(r[1]).decode()) for r in back) == sorted(
        (str(k), t or "") for k, t in rows)
    out = byte_bpe.digests(encoded)
    expected = []
    for key, text in rows:
        ids = library.encode_ordinary(text or "")
        data = np.asarray(ids, "<u4").tobytes()
        expected.append((str(key), len(ids), hashlib.sha256(data).hexdigest(),
                         hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted((str(r[0]), *r[1:]) for r in out.collect()) == sorted(expected)


def test_byte_bpe_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert byte_bpe.encode(df, RANKS, public_tokenizers.PATTERN).count() == 0


def test_word_encoder_as_the_library():
    from tokenizers import Tokenizer

    own, library = WordEncoder(WORD_BPE), Tokenizer.from_file(WORD_BPE)
    marks = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|end", "<| endoftext|>", "<|", "a<|endoftext|>b"]
    texts = _texts(300) + marks + [f"x {a}{b} y\n{b}" for a in marks for b in marks]
    assert library.encode("a <|endoftext|> b", add_special_tokens=False).ids == [320, 49407, 321]
    for text in texts:
        expected = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(own.encode(text.encode()), "<u4").tolist() == expected


def _check_packed(rows, length):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at and size > 0
            at += size
        assert at <= length
    return len(by_sequence)


def test_packing_keeps_every_token(spark):
    texts = _texts() + ["word " * 3000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, None), (2, "a"), (2, "a")]
    df = spark.createDataFrame([(k, t, 1) for k, t in rows], "doc_id long, text string, sequence_id int")
    pieces = packing.pieces(df, WORD_BPE)
    packed = packing.pack(pieces).collect()
    own, expected = WordEncoder(WORD_BPE), []
    for key, text in rows:
        data = own.encode((text or "").encode()) + b"\0\0\0\0"
        expected += [(str(key), k, k * 2048, len(data[k * 8192:][:8192]) // 4,
                      zlib.crc32(data[k * 8192:][:8192])) for k in range(-(-len(data) // 8192))]
    assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"])
                  for r in packed) == sorted(expected)
    total = sum(r["length"] for r in packed)
    assert _check_packed(packed, 2048) <= -(-total // 2048) + 1


def test_packing_in_groups_and_levels(spark):
    rng = np.random.default_rng(3)
    sizes = np.minimum(rng.lognormal(6, 1, 4000).astype(int) + 1, 2048)
    df = spark.createDataFrame([(i, int(s)) for i, s in enumerate(sizes)], "id long, length long")
    packed = packing.pack(df, group_pieces=500).collect()
    assert sorted((r["id"], r["length"]) for r in packed) == sorted(enumerate(map(int, sizes)))
    assert _check_packed(packed, 2048) <= 1.01 * sizes.sum() / 2048 + 1
    assert packing.pack(df.limit(0)).count() == 0


def test_sum_of_squares_places_where_the_sum_is_least():
    rng = np.random.default_rng(0)
    for _ in range(20):
        sizes, length = rng.integers(1, 11, 40), 10
        gaps, counts = {}, np.zeros(length + 1, int)
        placed = packing.squares(sizes, length)
        for where, s in zip(placed.tolist(), sizes.tolist(), strict=True):
            def cost(gap, s=s, counts=counts):
                after = counts.copy()
                after[gap] -= gap < length
                after[gap - s] += 1
                return (after[1:length] ** 2).sum()

            options = {g: cost(g) for g in [length, *np.flatnonzero(counts)] if g >= s and g}
            gap = gaps.get(where, length)
            assert options[gap] == min(options.values())
            counts[gap] -= gap < length
            gaps[where] = gap - s
            if gap - s:
                counts[gap - s] += 1


def test_packing_of_lengths_without_partners_ends(spark, monkeypatch):
    rng = random.Random(9)
    sizes = [1100] * 700 + [rng.randint(1, 2048) for _ in range(1400)]
    stored = packing.cut(spark.createDataFrame(list(enumerate(sizes)), "doc_id long, length long"))
    levels = []

    def counted(df, cut=packing.cut):
        levels.append(df)
        assert len(levels) < 12, "levels go on"
        return cut(df)

    monkeypatch.setattr(packing, "cut", counted)
    out = packing.pack(stored, group_pieces=100).collect()
    assert sorted((r["doc_id"], r["length"]) for r in out) == list(enumerate(sizes))
    by = {}
    for r in out:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        end = 0
        for offset, size in sorted(parts):
            assert offset == end
            end += size
        assert end <= 2048
    alone = sum(x > 1024 for x in sizes)
    assert len(by) <= 1.05 * max(alone, -(-sum(sizes) // 2048))


def test_bulk_best_fit_places_each_rank_once():
    rng = random.Random(2)
    for _ in range(50):
        counts = {rng.randint(1, 50): rng.randint(1, 40) for _ in range(rng.randint(1, 12))}
        seen, by = set(), {}
        for size, rank, n, first, offset in packing.by_counts(counts, 50):
            for k in range(n):
                assert (size, rank + k) not in seen
                seen.add((size, rank + k))
                by.setdefault(first + k, []).append((offset, size))
        assert seen == {(s, r) for s, n in counts.items() for r in range(n)}
        for parts in by.values():
            assert sum(s for _, s in parts) <= 50
            assert [o for o, _ in sorted(parts)] == [sum(s for _, s in sorted(parts)[:i]) for i in range(len(parts))]
