"""Repeated passages, removed through run-length indexes.

Every window of ``WINDOW`` bytes names one anchor: the short string inside it
with the smallest hash. Equal windows name equal anchors at equal places, so
copies meet at their anchors, whatever stands around them. The windows that
share one anchor cover a stretch of at most 2 * WINDOW - GRAM bytes, its
context. So:

1. Each task finds the anchors of its texts and sends their hashes, the hashes
   of their contexts and their places to the task of the anchor. Contexts that
   a task sees twice are copies at once.
2. Where an anchor repeats, a context that stood before is a copy as a whole.
   Contexts that differ can share a window only if they also share the anchor
   with SIDE bytes to its left or to its right, as every window holds one of
   the two. Each record carries a hash of both, and only contexts that share
   one are fetched: chance repeats of short strings, which outgrow the input,
   end here.
3. Of each anchor, the first context goes into a run-length index (see
   ``run_index``), and the matching statistics of all others are streamed
   against it. Matches of WINDOW bytes or more are marked. The windows of the
   others that the first context doesn't have are compared among themselves.

What travels is a few bytes per anchor, two anchors for about 40 bytes; then
contexts at the edges of copies; then spans.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.llm.frames import cut, reachable
from oreflow.llm.run_index import RunIndex

WINDOW, GRAM = 100, 24
#: Of the bytes that a window holds beside its anchor, at least so many are on one side.
SIDE = (WINDOW - GRAM) // 2
#: Longer texts are taken in overlapping stretches of half as many bytes.
STRETCH = 2_000_000
#: Bytes of short texts looked at together, few enough for a core's cache.
GROUP = 250_000

_random = np.random.default_rng(7)
_BYTE = _random.integers(0, 2 ** 64, 256, dtype=np.uint64)
_BASE = int(_random.integers(0, 2 ** 62)) * 2 + 1
_MASK = 2 ** 64 - 1
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(32)
_POWERS: list[np.ndarray] = []

#: One anchor: hashes of anchor and context, key and tie of its row, place of
#: the first window, the anchor's place in it, windows less one, hashes of the
#: anchor with SIDE bytes to its left and right, 0 where the context has fewer.
ANCHOR = np.dtype([("a", "<u8"), ("c", "<u8"), ("doc", "<i8"), ("tie", "<i4"),
                   ("start", "<i8"), ("at", "u1"), ("more", "u1"), ("left", "<u4"), ("right", "<u4")])


def _power(n: int) -> np.uint64:
    return np.uint64(pow(_BASE, n, 2 ** 64))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _SHIFT)) * _ODD
    return h ^ (h >> _SHIFT)


def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, made once per worker."""
    if not _POWERS or len(_POWERS[0]) <= STRETCH:
        _POWERS.clear()
        for base in (_BASE, pow(_BASE, -1, 2 ** 64)):
            steps = np.full(STRETCH + 1, np.uint64(base), np.uint64)
            steps[0] = 1
            _POWERS.append(np.cumprod(steps, dtype=np.uint64))
    return _POWERS[0], _POWERS[1]


def _slid(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of each ``width`` neighbours."""
    reach = 1
    while 2 * reach <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def anchors(buffer: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """(first window, last window, anchor, hashes of anchor, context, left and right) over texts end to end.

    ``ends`` are the ends of the texts in the buffer; windows lie inside a text.
    """
    n = len(buffer)
    none = (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),) * 2 + (np.empty(0, np.uint32),) * 2
    if n < WINDOW:
        return none
    x = _BYTE[buffer]
    hashes, width = x, 1
    sums = {1: x}
    while 2 * width <= GRAM:
        hashes = hashes[:-width] * _power(width) + hashes[width:]
        width *= 2
        sums[width] = hashes
    gram, have = sums[width], width
    while have < GRAM:
        add = max(w for w in sums if w <= GRAM - have)
        m = n - have - add + 1
        gram = gram[:m] * _power(add) + sums[add][have:have + m]
        have += add
    gram = _mixed(gram)
    # The place breaks ties, so the first of equal anchors is the window's.
    places = np.arange(len(gram), dtype=np.uint64)
    packed = (gram & np.uint64(_MASK ^ 0xFFFFFF)) | places
    least = _slid(packed, WINDOW - GRAM + 1)
    valid = np.ones(len(least), bool)
    starts = np.r_[0, ends[:-1]]
    bad = np.zeros(n + 1, np.int32)
    lows = np.maximum(starts, ends - WINDOW + 1)
    np.add.at(bad, lows, 1)
    np.add.at(bad, ends, -1)
    valid &= np.cumsum(bad)[:len(least)] == 0
    first = np.flatnonzero(valid)
    if not len(first):
        return none
    spot = (least[first] & np.uint64(0xFFFFFF)).astype(np.int64)
    new = np.flatnonzero(np.r_[True, (spot[1:] != spot[:-1]) | (first[1:] != first[:-1] + 1)])
    low, high, spot = first[new], first[np.r_[new[1:], len(first)] - 1], spot[new]
    forward, backward = _powers()
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(x * forward[:n], out=total[1:])

    def between(begin, end):
        return (total[end] - total[begin]) * backward[begin]

    def side(begin, end):
        inside = (begin >= low) & (end <= high + WINDOW)
        begin, end = np.maximum(begin, low), np.minimum(end, high + WINDOW)
        return np.where(inside, np.maximum(_mixed(between(begin, end)) >> _SHIFT, 1), 0).astype(np.uint32)

    shape = ((high - low) * 256 + (spot - low)).astype(np.uint64) * _ODD
    return (low, high, spot, gram[spot], _mixed(between(low, high + WINDOW) ^ _mixed(shape)),
            side(spot - SIDE, spot + GRAM), side(spot, spot + GRAM + SIDE))


def _repeated(*keys: np.ndarray) -> np.ndarray:
    """Which rows have keys that another row has, too."""
    order = np.lexsort(keys) if len(keys) > 1 else np.argsort(keys[0])
    same = np.ones(max(len(order) - 1, 0), bool)
    for k in keys:
        k = k[order]
        same &= k[1:] == k[:-1]
    out = np.zeros(len(order), bool)
    out[order[1:][same]] = out[order[:-1][same]] = True
    return out


def _copies(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(firsts, copies): the earliest of each anchor and context, and all later ones.

    Firsts are sorted by anchor. Records of one place are one.
    """
    order = np.lexsort((found["start"], found["tie"], found["doc"], found["c"], found["a"]))
    found = found[order]
    if not len(found):
        return found, found
    again = np.r_[False, (found["a"][1:] == found["a"][:-1]) & (found["c"][1:] == found["c"][:-1])]
    first = np.maximum.accumulate(np.where(again, 0, np.arange(len(found))))
    moved = np.zeros(len(found), bool)
    for f in ("doc", "tie", "start"):
        moved |= found[f] != found[f][first]
    return found[~again], found[again & moved]


def merged(doc: np.ndarray, tie: np.ndarray, start: np.ndarray, end: np.ndarray):
    """The same spans with those that touch joined, per row."""
    order = np.lexsort((start, tie, doc))
    doc, tie, start, end = doc[order], tie[order], start[order], end[order]
    if not len(doc):
        return doc, tie, start, end
    group = np.cumsum(np.r_[False, (doc[1:] != doc[:-1]) | (tie[1:] != tie[:-1])]).astype(np.int64)
    # Ends may be compared across rows once each row lies behind the last.
    span = int(end.max()) + 2
    reach = np.maximum.accumulate(end + group * span)
    new = np.r_[True, (start + group * span)[1:] > reach[:-1]]
    at = np.flatnonzero(new)
    return doc[at], tie[at], start[at], (reach - group * span)[np.r_[at[1:], len(doc)] - 1]


def _stretches(texts: list[bytes]) -> Iterator[list[tuple[int, int, bytes]]]:
    """Groups of (text number, its first byte, bytes): GROUP bytes, or one stretch."""
    group, size = [], 0
    step = STRETCH // 2
    for i, text in enumerate(texts):
        for base in range(0, max(len(text), 1), step):
            piece = text[base:base + step + WINDOW - 1]
            if len(piece) < WINDOW:
                continue
            if group and size + len(piece) > min(GROUP, STRETCH):
                yield group
                group, size = [], 0
            group.append((i, base, piece))
            size += len(piece)
    if group:
        yield group


def _anchors_of(docs: np.ndarray, ties: np.ndarray, texts: list[bytes]) -> np.ndarray:
    parts = []
    for group in _stretches(texts):
        sizes = np.array([len(p) for _, _, p in group], np.int64)
        ends = np.cumsum(sizes)
        low, high, spot, a, c, left, right = anchors(np.frombuffer(b"".join([p for _, _, p in group]), np.uint8), ends)
        owner = np.searchsorted(ends, low, "right")
        number = np.array([i for i, _, _ in group], np.int64)[owner]
        base = (np.array([b for _, b, _ in group], np.int64) - (ends - sizes))[owner]
        out = np.empty(len(low), ANCHOR)
        out["a"], out["c"], out["doc"], out["tie"] = a, c, docs[number], ties[number]
        out["start"], out["at"], out["more"] = low + base, spot - low, high - low
        out["left"], out["right"] = left, right
        parts.append(out)
    return np.concatenate(parts) if parts else np.empty(0, ANCHOR)


_SPANS = "kind int, doc long, tie int, start long, end long, anchor long, at int"


def _span_batch(kind: int, doc, tie, start, end, anchor=None, at=None) -> pa.RecordBatch:
    n = len(doc)
    anchor = np.zeros(n, np.int64) if anchor is None else anchor
    at = np.zeros(n, np.int32) if at is None else at
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, kind, np.int32)), pa.array(np.ascontiguousarray(doc)),
         pa.array(np.ascontiguousarray(tie)), pa.array(np.ascontiguousarray(start)),
         pa.array(np.ascontiguousarray(end)), pa.array(anchor), pa.array(at)],
        names=["kind", "doc", "tie", "start", "end", "anchor", "at"])


_BLOB = pa.Codec("zstd", compression_level=1)
COPIES, FETCH = 0, 1


def _packed(records: np.ndarray) -> bytes:
    """Column by column, so that sorted places compress."""
    raw = b"".join([np.ascontiguousarray(records[f]).tobytes() for f in records.dtype.names])
    return _BLOB.compress(raw, asbytes=True)


def _unpacked(blob: bytes, n: int, kind: np.dtype) -> np.ndarray:
    raw = _BLOB.decompress(blob, n * kind.itemsize, asbytes=True)
    out, at = np.empty(n, kind), 0
    for f in kind.names:
        width = n * kind[f].itemsize
        out[f] = np.frombuffer(raw[at:at + width], kind[f])
        at += width
    return out


SPAN = np.dtype([("doc", "<i8"), ("tie", "<i4"), ("start", "<i8"), ("end", "<i8")])


def _find(parts: int):
    """Anchors of the texts of a batch, packed by target part; copies inside the batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = np.asarray(batch.column("doc").to_numpy(zero_copy_only=False), np.int64)
            ties = np.asarray(batch.column("tie").to_numpy(zero_copy_only=False), np.int32)
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            found = _anchors_of(docs, ties, texts)
            pair = _repeated(found["a"])
            firsts, copies = _copies(found[pair])
            found = np.concatenate([found[~pair], firsts])
            doc, tie, start, end = merged(
                copies["doc"], copies["tie"], copies["start"],
                copies["start"] + copies["more"] + WINDOW)
            spans = np.empty(len(doc), SPAN)
            spans["doc"], spans["tie"], spans["start"], spans["end"] = doc, tie, start, end
            rows = []
            for records, part in (
                    (found, (found["a"] >> _SHIFT).astype(np.int64) % parts),
                    (spans, np.abs(doc) % parts)):
                by_part = np.lexsort((records["doc"], part))
                edges = np.searchsorted(part[by_part], np.arange(parts + 1))
                for p in range(parts):
                    own = records[by_part[edges[p]:edges[p + 1]]]
                    if len(own):
                        rows.append((p, "end" in own.dtype.names, len(own), _packed(own)))
            part, is_span, n, blob = zip(*rows, strict=True) if rows else ((),) * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), pa.array(is_span, pa.bool_()), pa.array(n, pa.int32()),
                 pa.array(blob, pa.binary())], names=["part", "spans", "n", "blob"])

    return run


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All anchors of some parts: copies, and the contexts to fetch."""
    found = []
    for batch in batches:
        for is_span, n, blob in zip(*[batch.column(c).to_pylist() for c in ("spans", "n", "blob")],
                                    strict=True):
            if is_span:
                spans = _unpacked(blob, n, SPAN)
                yield _span_batch(COPIES, *[spans[f] for f in SPAN.names])
            else:
                found.append(_unpacked(blob, n, ANCHOR))
    if not found:
        return
    records = np.concatenate(found)
    del found
    firsts, copies = _copies(records[_repeated(records["a"])])
    yield _span_batch(COPIES, *merged(
        copies["doc"], copies["tie"], copies["start"], copies["start"] + copies["more"] + WINDOW))
    # Where no other context has the same bytes on a side, nothing else can be a copy.
    a = firsts["a"]
    wanted = firsts[_repeated(a, firsts["left"]) & (firsts["left"] > 0)
                    | _repeated(a, firsts["right"]) & (firsts["right"] > 0)]
    yield _span_batch(
        FETCH, wanted["doc"], wanted["tie"], wanted["start"],
        wanted["start"] + wanted["more"] + WINDOW, wanted["a"].view(np.int64),
        wanted["at"].astype(np.int32))


def _listed(column: pa.Array) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """(row, fields) of the structs in a column of lists, null lists being empty."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    flat = column.flatten()
    fields = {f.name: x.to_numpy(zero_copy_only=False) for f, x in zip(flat.type, flat.flatten(), strict=True)}
    return np.repeat(np.arange(len(column)), sizes), fields


def _contexts(parts: int):
    """The bytes of the contexts that were asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:]
            data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
            owners, wanted = _listed(batch.column("wanted"))
            docs, ties = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc", "tie"))
            for low in range(0, len(owners), 20_000):
                owner = owners[low:low + 20_000]
                anchor, start, end, at = (wanted[f][low:low + 20_000] for f in ("anchor", "start", "end", "at"))
                size = end - start
                ends = np.cumsum(size)
                places = np.repeat(offsets[owner] + start - (ends - size), size) + np.arange(ends[-1])
                bounds = np.r_[0, ends].astype(np.int32)
                context = pa.Array.from_buffers(
                    pa.binary(), len(owner), [None, pa.py_buffer(bounds), pa.py_buffer(data[places])])
                part = ((anchor.view(np.uint64) >> _SHIFT) % np.uint64(parts)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part), pa.array(anchor), pa.array(docs[owner]), pa.array(ties[owner]),
                     pa.array(start), pa.array(at), context],
                    names=["part", "anchor", "doc", "tie", "start", "at", "context"])

    return run


def _matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Copies among the contexts of some anchors."""
    tables = list(batches)
    if not sum(b.num_rows for b in tables):
        return
    table = pa.Table.from_batches(tables)
    del tables
    anchor, doc, tie, start = (table.column(c).to_numpy() for c in ("anchor", "doc", "tie", "start"))
    texts = table.column("context").to_pylist()
    del table
    order = np.lexsort((start, tie, doc, anchor))
    same = np.ones(len(order) - 1, bool)
    for x in (anchor, doc, tie, start):
        same &= x[order][1:] == x[order][:-1]
    order = order[np.r_[True, ~same]]
    first = np.r_[True, anchor[order][1:] != anchor[order][:-1]]
    others = order[~first]
    sizes = np.array([len(texts[i]) for i in others], np.int64)
    index = RunIndex([texts[i] for i in order[first]])
    rests = []
    for low in range(0, len(others), 20_000):
        part, size = others[low:low + 20_000], sizes[low:low + 20_000]
        lengths, _ = index.matching([texts[i] for i in part])
        yield from _windows(lengths >= WINDOW, part, size, doc, tie, start)
        rests.append(_left(lengths >= WINDOW, part, size, texts, doc, tie, start))
    if not len(others):
        return
    joined = [np.concatenate(x) for x in zip(*rests, strict=True)]
    hashed, doc, tie, start = joined
    order = np.lexsort((start, tie, doc, hashed))
    again = np.r_[False, hashed[order][1:] == hashed[order][:-1]] if len(order) else np.empty(0, bool)
    again = order[again]
    yield _span_batch(COPIES, *merged(doc[again], tie[again], start[again], start[again] + WINDOW))


def _windows(hit: np.ndarray, part, size, doc, tie, start) -> Iterator[pa.RecordBatch]:
    """Spans of the windows marked in right-aligned rows."""
    row, column = np.nonzero(hit)
    begin = start[part[row]] + size[row] - 1 - column
    yield _span_batch(COPIES, *merged(doc[part[row]], tie[part[row]], begin, begin + WINDOW))


def _left(hit: np.ndarray, part, size, texts, doc, tie, start) -> tuple[np.ndarray, ...]:
    """(hash, doc, tie, start) of the windows that the index doesn't have."""
    widest = hit.shape[1]
    if widest < WINDOW:
        return tuple(np.empty(0, t) for t in (np.uint64, np.int64, np.int32, np.int64))
    joined = np.frombuffer(b"".join([texts[i] for i in part]), np.uint8)
    x = _BYTE[joined]
    total, width, have = x, 1, 1
    sums = {1: x}
    while 2 * width <= WINDOW:
        total = total[:-width] * _power(width) + total[width:]
        width *= 2
        sums[width] = total
    have = width
    while have < WINDOW:
        add = max(w for w in sums if w <= WINDOW - have)
        m = len(x) - have - add + 1
        total = total[:m] * _power(add) + sums[add][have:have + m]
        have += add
    begins = np.cumsum(size) - size
    column = np.arange(widest)[None, :]
    open_ = ~hit & (column >= WINDOW - 1) & (column < size[:, None])
    row, column = np.nonzero(open_)
    offset = size[row] - 1 - column
    return (_mixed(total[begins[row] + offset]), doc[part[row]], tie[part[row]],
            start[part[row]] + offset)


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, tie, spans): byte spans to remove, per row that has any.

    ``tie`` is a hash of the text, to tell rows of one key apart. Null keys go
    as the smallest number of their type.
    """
    return _spans(_keyed(docs, key, text), docs)


def _spans(source: DataFrame, docs: DataFrame) -> DataFrame:
    """As ``repeated_spans``. ``source`` is joined whole, so that its shuffle is used again."""
    # Tasks follow the number of input splits. Each is one part: with more, blobs
    # would grow in number as the square of the input.
    tasks = 4 * max(1, docs.rdd.getNumPartitions())
    met = cut(
        source.select("doc", "tie", "text").mapInArrow(_find(tasks), "part int, spans boolean, n int, blob binary")
        .repartitionById(tasks, F.col("part")).mapInArrow(_meet, _SPANS))
    wanted = met.where(F.col("kind") == FETCH).groupBy("doc", "tie").agg(
        F.collect_list(F.struct("anchor", "start", "end", "at")).alias("wanted"))
    matched = (
        source.join(wanted, ["doc", "tie"])
        .mapInArrow(_contexts(tasks), "part int, anchor long, doc long, tie int, start long, "
                                      "at int, context binary")
        .repartitionById(tasks, F.col("part")).mapInArrow(_matched, _SPANS))
    copies = met.where(F.col("kind") == COPIES).unionByName(matched)
    return copies.groupBy("doc", "tie").agg(
        F.collect_list(F.struct("start", "end")).alias("spans"))


def _keyed(docs: DataFrame, key: str, text: str, *more) -> DataFrame:
    value = F.coalesce(text, F.lit(""))
    return reachable(docs).select(
        F.coalesce(F.col(key).cast("long"), F.lit(-2 ** 63)).alias("doc"),
        F.shiftright(F.xxhash64(value), 32).cast("int").alias("tie"), value.alias("text"), *more)


def _cut(whole_characters: bool):
    """Rows of (row, text, spans) to what is left of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            owner, spans = _listed(batch.column("spans"))
            owner, _, low, high = merged(owner, np.zeros(len(owner), np.int32), spans["start"], spans["end"])
            edges = np.searchsorted(owner, np.arange(len(texts) + 1))
            n_spans, edges, low, high = np.diff(edges), edges.tolist(), low.tolist(), high.tolist()
            n_bytes, n_removed, kept = [], [], []
            for i, data in enumerate(texts):
                here = slice(edges[i], edges[i + 1])
                left = b"".join([data[x:y] for x, y in zip(
                    [0, *high[here]], [*low[here], len(data)], strict=True)])
                n_bytes.append(len(data))
                n_removed.append(len(data) - len(left))
                kept.append(left.decode("utf-8", "ignore").encode() if whole_characters else left)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(n_spans, pa.int64()), pa.array(kept, pa.binary())],
                names=["row", "n_bytes", "n_removed", "n_spans", "kept"])

    return run


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text",
                   whole_characters: bool = False) -> DataFrame:
    """(row, n_bytes, n_removed, n_spans, kept) for every row of ``docs``.

    ``row`` is a struct of all its columns but the text, ``kept`` the remaining
    bytes, on wish without characters of which only a part is left. A byte goes if a string of WINDOW bytes over it also starts earlier:
    in a smaller key, or in the same text further up. Overlaps count, strings
    are judged on the input, and matches don't cross texts. Null texts count as
    empty. Null keys sort first; rows of one key are ordered by a hash of their
    text, and rows equal in both come back with the same result, judged as one.
    An empty table gives no rows. ``docs`` must give the same rows again.
    """
    row = F.struct(*[c for c in docs.columns if c != text]).alias("row")
    source = _keyed(docs, key, text, row)
    rows = source.join(_spans(source, docs), ["doc", "tie"], "left")
    counts = [T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")]
    return rows.mapInArrow(_cut(whole_characters), T.StructType(
        [rows.schema["row"], *counts, T.StructField("kept", T.BinaryType())]))
