"""Token counts by a linear longest-match automaton.

A word is a start mark and its characters. Greedy word pieces take, again and
again, the longest vocabulary entry that starts where the last one ended. A
trie of the vocabulary answers this in one pass: where no child matches, the
failure link of the node leads to the trie path that is left over once the
pieces in front of it are popped, and the number of those pieces is stored
with the node. So a word costs its length, and no piece is ever built.

A character that starts no entry counts as the bytes of its UTF-8 form.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from oreflow.llm.frames import reachable

START = "▁"
#: Entries of a worker's word cache; it is emptied when full.
CACHED_WORDS = 400_000


class LongestMatch:
    """Automaton over the entries of a vocabulary."""

    def __init__(self, vocabulary: Iterable[str]):
        entries = {x for x in vocabulary if x}
        self.children: list[dict[str, int]] = [{}]
        strings, order = [""], []
        for entry in entries:
            node = 0
            for c in entry:
                nxt = self.children[node].get(c)
                if nxt is None:
                    nxt = self.children[node][c] = len(self.children)
                    self.children.append({})
                    strings.append(strings[node] + c)
                    order.append((len(strings[nxt]), node, c, nxt))
                node = nxt
        n = len(self.children)
        self.link, self.popped = [0] * n, [0] * n
        for _, parent, c, node in sorted(order):
            if strings[node] in entries:
                self.popped[node] = 1
                continue
            if parent == 0:
                self.popped[node] = len(c.encode("utf-8", "replace"))
                continue
            state, count = self.link[parent], self.popped[parent]
            while c not in self.children[state] and state:
                count += self.popped[state]
                state = self.link[state]
            if c in self.children[state]:
                self.link[node], self.popped[node] = self.children[state][c], count
            else:
                self.popped[node] = count + len(c.encode("utf-8", "replace"))

    def count(self, word: str) -> int:
        """Pieces of one word, its start mark included."""
        children, link, popped = self.children, self.link, self.popped
        state, count = 0, 0
        for c in word:
            while True:
                nxt = children[state].get(c)
                if nxt is not None:
                    state = nxt
                    break
                if not state:
                    count += len(c.encode("utf-8", "replace"))
                    break
                count += popped[state]
                state = link[state]
        while state:
            count += popped[state]
            state = link[state]
        return count


def piece_vocabulary(path: str) -> list[str]:
    """Ordinary entries of a sentencepiece model."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [model.id_to_piece(i) for i in range(model.get_piece_size())
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]


_WORKER: dict[str, tuple[LongestMatch, dict[bytes, int]]] = {}


def _worker(path: str) -> tuple[LongestMatch, dict[bytes, int]]:
    if path not in _WORKER:
        _WORKER[path] = (LongestMatch(piece_vocabulary(path)), {})
    return _WORKER[path]


def count_tokens(docs: DataFrame, model_path: str, key: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """(key, n_words, n_tokens) for every row, in one pass without a shuffle.

    Null and empty texts have no words and no tokens; repeated rows are counted
    each; an empty table gives no rows. Columns beside key and text are not read.
    """
    schema = f"`{key}` {docs.schema[key].dataType.simpleString()}, n_words long, n_tokens long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, known = _worker(model_path)
        count = automaton.count
        for batch in batches:
            n_words, n_tokens = [], []
            for value in batch.column(1).cast(pa.binary()):
                words = (value.as_py() or b"").split()  # ASCII white space only
                tokens = 0
                for w in words:
                    n = known.get(w)
                    if n is None:
                        if len(known) >= CACHED_WORDS:
                            known.clear()
                        n = count(START + w.decode("utf-8", "replace"))
                        if len(w) <= 64:
                            known[w] = n
                    tokens += n
                n_words.append(len(words))
                n_tokens.append(tokens)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_tokens, pa.int64())],
                names=[key, "n_words", "n_tokens"])

    return reachable(docs).select(key, text).mapInArrow(run, schema)
