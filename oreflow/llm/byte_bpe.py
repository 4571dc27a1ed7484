"""Byte-level BPE by overlapping chunks, and decoding.

Texts are cut into chunks that overlap. Each chunk is pre-tokenised on its own,
so one very long text is spread over tasks. A boundary found in two chunks at
the same place makes them agree from there on, since a match depends only on
what stands at and after its start; stitching follows one chunk until the next
one knows the place. Where an overlap holds no common boundary (a run longer
than the overlap), the next match is searched in the joined text instead. The
stitched pieces are then encoded one by one.

Decoding concatenates the bytes of the ids.
"""

from __future__ import annotations

import base64
import sys
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.llm.frames import reachable

#: Characters of a chunk, and how far it reaches into the next one.
CHUNK, OVERLAP = 16_384, 512
#: Entries of a worker's cache of pieces; it is emptied when full.
CACHED_PIECES = 400_000

#: White space as the vocabulary's own library sees it; Python's class has four
#: control characters more.
_BLANK = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def portable(pattern: str) -> str:
    """The same pattern with white space spelled out."""
    out, in_class, i = [], False, 0
    while i < len(pattern):
        pair = pattern[i:i + 2]
        if pair == r"\s":
            out.append(_BLANK if in_class else f"[{_BLANK}]")
            i += 2
        elif pair == r"\S" and not in_class:
            out.append(f"[^{_BLANK}]")
            i += 2
        elif pair[0] == "\\":
            out.append(pair)
            i += 2
        else:
            in_class = {"[": True, "]": False}.get(pair[0], in_class)
            out.append(pair[0])
            i += 1
    return "".join(out)


_LITTLE = sys.byteorder == "little"


class Codec:
    """Ranks of a vocabulary with the pattern that splits texts."""

    def __init__(self, rank_file: str, pattern: str):
        import regex
        import tiktoken

        with open(rank_file, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.pattern = regex.compile(portable(pattern))
        self.core = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})._core_bpe
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.known: dict[str, bytes] = {}

    def boundaries(self, text: str) -> list[int]:
        """Starts of the pieces. The pattern leaves no gap."""
        return [m.start() for m in self.pattern.finditer(text)]

    def encode(self, pieces: list[str]) -> bytes:
        """Ids as little-endian 32-bit numbers."""
        known, fresh = self.known.get, self._fresh
        return b"".join([known(p) or fresh(p) for p in pieces])

    def _fresh(self, piece: str) -> bytes:
        ids = np.asarray(self.core.encode_single_piece(piece.encode("utf-8")), "<u4").tobytes()
        if len(piece) <= 48:
            if len(self.known) >= CACHED_PIECES:
                self.known.clear()
            self.known[piece] = ids
        return ids

    def decode(self, ids: bytes) -> bytes:
        of = self.bytes_of
        return b"".join([of[i] for i in memoryview(ids).cast("I")] if _LITTLE else [
            of[i] for i in np.frombuffer(ids, "<u4").tolist()])


def chunks_of(text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[tuple[int, str]]:
    """(start, text) of the chunks; an empty text has one empty chunk."""
    return [(s, text[s:s + chunk + overlap]) for s in range(0, max(len(text), 1), chunk)]


def stitch(codec: Codec, chunks: list[tuple[int, str, list[int]]], chunk: int) -> list[str]:
    """Pieces of the whole text from (start, text, boundaries) of its chunks."""
    text = "".join([t if k + 1 == len(chunks) else t[:chunk] for k, (_, t, _) in enumerate(chunks)])
    cuts: list[int] = []
    at = 0
    for k, (start, piece, found) in enumerate(chunks):
        last = k + 1 == len(chunks)
        limit, end = (len(text), len(text)) if last else (start + chunk, start + len(piece))
        i = bisect_left(found, at - start)
        while at < limit and not (i < len(found) and found[i] == at - start):
            cuts.append(at)  # not yet in step: search in the whole text
            at = codec.pattern.match(text, at).end()
            i = bisect_left(found, at - start)
        while at < limit and i < len(found):
            stop = start + found[i + 1] if i + 1 < len(found) else end
            if not last and stop >= end - 1:
                break  # what comes behind the chunk may change this match
            cuts.append(at)
            at, i = stop, i + 1
    while at < len(text):
        cuts.append(at)
        at = codec.pattern.match(text, at).end()
    return [text[a:b] for a, b in zip(cuts, [*cuts, len(text)][1:], strict=True)]


_WORKER: dict[tuple[str, str], Codec] = {}


def codec(rank_file: str, pattern: str) -> Codec:
    """One per worker process."""
    if (rank_file, pattern) not in _WORKER:
        _WORKER[rank_file, pattern] = Codec(rank_file, pattern)
    return _WORKER[rank_file, pattern]


def encode(docs: DataFrame, rank_file: str, pattern: str, key: str = "doc_id", text: str = "text",
           chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(key, ids, decoded): ids as little-endian unsigned 32-bit numbers, and what they decode to.

    A text of one chunk stays in its task. The chunks of longer ones are dealt
    out for pre-tokenising, then meet again per row; a row, not its key, is
    what they meet by, so null and repeated keys do no harm. Null texts count
    as empty, and empty ones have no ids. Columns beside key and text are not
    read.
    """
    out = f"`{key}` {docs.schema[key].dataType.simpleString()}, ids binary, decoded binary"
    rows = reachable(docs).select(key, F.coalesce(text, F.lit("")).alias("text"))

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(rank_file, pattern)
        for batch in batches:
            done = [own.encode(own.pattern.findall(value.as_py())) for value in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(done, pa.binary()),
                 pa.array([own.decode(ids) for ids in done], pa.binary())], names=[key, "ids", "decoded"])

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(rank_file, pattern)
        for batch in batches:
            found = [np.asarray(own.boundaries(t.as_py()), "<u4").tobytes()
                     for t in batch.column("chunk")]
            yield batch.append_column("found", pa.array(found, pa.binary()))

    def joined(frame: pd.DataFrame) -> pd.DataFrame:
        own = codec(rank_file, pattern)
        frame = frame.sort_values("start")
        parts = [(int(s), t, np.frombuffer(f, "<u4").tolist())
                 for s, t, f in zip(frame["start"], frame["chunk"], frame["found"], strict=True)]
        ids = own.encode(stitch(own, parts, chunk))
        return pd.DataFrame({key: frame[key].iloc[:1], "ids": [ids], "decoded": [own.decode(ids)]})

    def apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                parts = chunks_of(batch.column("text")[i].as_py(), chunk, overlap)
                same = pa.array([i] * len(parts))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(key).take(same), batch.column("row").take(same),
                     pa.array([s for s, _ in parts], pa.int64()),
                     pa.array([t for _, t in parts], pa.string())],
                    names=[key, "row", "start", "chunk"])

    kind = docs.schema[key].dataType.simpleString()
    spread = (
        rows.where(F.length("text") > chunk)
        .withColumn("row", F.monotonically_increasing_id())
        .mapInArrow(apart, f"`{key}` {kind}, row long, start long, chunk string")
        .repartition(F.col("row"), F.col("start"))
        .mapInArrow(bounds, f"`{key}` {kind}, row long, start long, chunk string, found binary")
    )
    return rows.where(F.length("text") <= chunk).mapInArrow(short, out).unionByName(
        spread.groupBy("row").applyInPandas(joined, out))


def decode(encoded: DataFrame, rank_file: str, pattern: str, key: str = "doc_id") -> DataFrame:
    """(key, decoded) from (key, ids): the bytes of all ids one after another.

    Null ids decode to no bytes. Bytes need not be whole characters.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(rank_file, pattern)
        for batch in batches:
            texts = [own.decode(ids.as_py() or b"") for ids in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.binary())], names=[key, "decoded"])

    kind = encoded.schema[key].dataType.simpleString()
    return reachable(encoded).select(key, "ids").mapInArrow(run, f"`{key}` {kind}, decoded binary")


def digests(encoded: DataFrame, key: str = "doc_id") -> DataFrame:
    return encoded.select(
        key, F.expr("cast(octet_length(ids) div 4 as long)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
