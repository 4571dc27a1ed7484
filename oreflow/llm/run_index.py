"""Run-length index: a run-compressed Burrows-Wheeler transform with sampled run ends.

Equal neighbours in the transform are one run. For each run the index holds its
start, its character, where its rows go one step to the left, and the text
places of its first and last row. Matching statistics are streamed from the
right end of a pattern: as long as the row's character fits, the row steps left;
else it jumps to the end of the last run or the start of the next run of that
character, whichever shares more with the row, and takes the sampled place
there. Many patterns step together.
"""

from __future__ import annotations

import numpy as np


#: Characters named together at first; each takes 9 bits of a word.
TOGETHER = 7


def _words(text: np.ndarray) -> np.ndarray:
    """The next ``TOGETHER`` characters from each place in one number, 0 behind the end."""
    n = len(text)
    padded = np.zeros(n + TOGETHER, np.int64)
    padded[:n] = text + 1
    words = np.zeros(n + 1, np.int64)
    for j in range(TOGETHER):
        words = words << 9 | padded[j:j + n + 1]
    return words


def suffix_order(words: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; what stands alone is not sorted again."""
    n = len(words) - 1
    order = np.argsort(words[:n])
    sorted_ = words[order]
    new = np.r_[True, sorted_[1:] != sorted_[:-1]] if n else np.empty(0, bool)
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    step = TOGETHER
    mixed = np.flatnonzero(~(new & np.r_[new[1:], True])) if n else order
    while len(mixed):
        suffix = order[mixed]
        behind = np.zeros(len(mixed), np.int64)
        inside = suffix + step < n
        behind[inside] = rank[suffix[inside] + step] + 1
        key = rank[suffix] * (n + 1) + behind
        by_key = np.argsort(key)
        key = key[by_key]
        order[mixed] = suffix = suffix[by_key]
        new = np.r_[True, key[1:] != key[:-1]]
        rank[suffix] = mixed[np.maximum.accumulate(np.where(new, np.arange(len(mixed)), 0))]
        mixed = mixed[~(new & np.r_[new[1:], True])]
        step *= 2
    return order


def common_prefixes(order: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Length shared with the suffix before, word by word."""
    n = len(order)
    length = np.zeros(n, np.int64)
    left = np.arange(1, n)
    a, b = order[1:], order[:-1]
    while len(left):
        differ = words[a] ^ words[b]
        # Equal words hold no end: of two suffixes, one ends first.
        last = differ != 0
        ends, differ = left[last], differ[last]
        for j in range(1, TOGETHER):
            length[ends] += differ >> 9 * (TOGETHER - j) == 0
        left, a, b = left[~last], a[~last] + TOGETHER, b[~last] + TOGETHER
        length[left] += TOGETHER
    return length


class RunIndex:
    """Index of several texts; matches never cross from one into the next."""

    def __init__(self, texts: list[bytes]):
        joined = b"".join(texts)
        sizes = np.array([len(t) for t in texts], np.int64)
        # Characters count from 1; each text ends with a 0, which no pattern has.
        self.starts = np.cumsum(np.r_[0, sizes + 1])[:-1] if len(texts) else sizes
        self.text = np.zeros(len(joined) + len(texts), np.int64)
        places = np.arange(len(joined)) + np.repeat(np.arange(len(texts)), sizes)
        self.text[places] = np.frombuffer(joined, np.uint8).astype(np.int64) + 1
        words = _words(self.text)
        order = suffix_order(words)
        self.n = len(order)
        self._minimum(common_prefixes(order, words))
        del words
        before = self.text[order - 1]
        change = np.flatnonzero(np.r_[True, before[1:] != before[:-1]]) if self.n else order
        self.run_start, self.run_char = change, before[change]
        self.first_place = order[change]
        self.last_place = order[np.r_[change[1:], self.n] - 1] if self.n else order
        sizes = np.diff(np.r_[change, self.n])
        smaller = np.cumsum(np.bincount(before, minlength=258))
        self.by_char = np.argsort(self.run_char, kind="stable")
        chars = self.run_char[self.by_char]
        ahead = np.cumsum(sizes[self.by_char]) - sizes[self.by_char]
        self.steps_to = np.empty(len(change), np.int64)
        # Rows of a character follow each other in run order, behind all smaller ones.
        self.steps_to[self.by_char] = ahead
        self.char_key = chars * (len(change) + 1) + self.by_char
        self.run_end = np.r_[change[1:], self.n]
        # The run that a run's first row steps into.
        self.steps_into = np.searchsorted(change, self.steps_to, "right") - 1
        self.present = np.r_[smaller[0] > 0, np.diff(smaller) > 0] if self.n else np.zeros(258, bool)

    def _minimum(self, common: np.ndarray) -> None:
        """Tables for the least common prefix between two rows."""
        self.least = [common.astype(np.int16 if not len(common) or common.max() < 32_000 else np.int64)]
        while 2 << len(self.least) - 1 <= len(common):
            last, half = self.least[-1], 1 << len(self.least) - 1
            self.least.append(np.minimum(last[:-half], last[half:]))

    def _shared(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Least common prefix over rows (low, high]; low < high."""
        span = high - low
        level = np.frexp(span.astype(np.float64))[1] - 1
        out = np.empty(len(low), np.int64)
        for k in np.unique(level):
            here = level == k
            table = self.least[k]
            out[here] = np.minimum(table[low[here] + 1], table[high[here] + 1 - (1 << int(k))])
        return out

    def matching(self, patterns: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(lengths, places) of the longest match from each place of each pattern.

        Rows are patterns, columns are places counted from the patterns' right
        ends: column 0 is the last character.
        """
        widest = max(map(len, patterns), default=0)
        lengths = np.zeros((len(patterns), widest), np.int64)
        places = np.full((len(patterns), widest), -1, np.int64)
        if not self.n or not widest:
            return lengths, places
        size = np.array([len(p) for p in patterns], np.int64)
        # Longest first: those that still have characters are the first ones. A step is a row.
        order = np.argsort(-size, kind="stable")
        bytes_ = np.frombuffer(b"".join(patterns), np.uint8)
        ends = np.cumsum(size)[order]
        open_ = np.searchsorted(-size[order], -np.arange(widest), "left")
        found = np.zeros((widest, len(patterns)), np.int64)
        at_places = np.full((widest, len(patterns)), -1, np.int64)
        at = np.zeros(len(patterns), np.int64)
        row = np.zeros(len(patterns), np.int64)
        place = np.full(len(patterns), self.first_place[0], np.int64)
        length = np.zeros(len(patterns), np.int64)
        for step, n in enumerate(open_):
            at, row, place, length = at[:n], row[:n], place[:n], length[:n]
            c = bytes_[ends[:n] - 1 - step].astype(np.int64) + 1
            go = self.present[c]
            jump = np.flatnonzero(go & (self.run_char[at] != c))
            if len(jump):
                self._jump(jump, c, at, row, place, length)
            stay = np.flatnonzero(~go)
            kept = at[stay], row[stay], place[stay]
            row = self.steps_to[at] + row - self.run_start[at]
            at = self.steps_into[at]
            place, length = place - 1, length + 1
            at[stay], row[stay], place[stay] = kept
            length[stay] = 0
            # Rows further down in a run may step into later runs.
            beyond = np.flatnonzero(row >= self.run_end[at])
            if len(beyond):
                at[beyond] += 1
                beyond = beyond[row[beyond] >= self.run_end[at[beyond]]]
                at[beyond] = np.searchsorted(self.run_start, row[beyond], "right") - 1
            found[step, :n], at_places[step, :n] = length, np.where(length > 0, place, -1)
        lengths[order], places[order] = found.T, at_places.T
        return lengths, places

    def _jump(self, jump, c, at, row, place, length) -> None:
        """Move rows to the nearer run of their character, in place."""
        runs = len(self.run_start)
        wanted = c[jump]
        spot = np.searchsorted(self.char_key, wanted * (runs + 1) + at[jump])
        next_run, last_run = self.by_char[np.minimum(spot, runs - 1)], self.by_char[np.maximum(spot - 1, 0)]
        h = np.flatnonzero((spot < runs) & (self.run_char[next_run] == wanted))
        p = np.flatnonzero((spot > 0) & (self.run_char[last_run] == wanted))
        down, up = np.full(len(jump), -1, np.int64), np.full(len(jump), -1, np.int64)
        down[h] = self._shared(row[jump[h]], self.run_start[next_run[h]])
        up[p] = self._shared(self.run_end[last_run[p]] - 1, row[jump[p]])
        use = down >= up
        target = np.where(use, next_run, last_run)
        row[jump] = np.where(use, self.run_start[target], self.run_end[target] - 1)
        place[jump] = np.where(use, self.first_place[target], self.last_place[target])
        length[jump] = np.minimum(length[jump], np.maximum(down, up))
        at[jump] = target
