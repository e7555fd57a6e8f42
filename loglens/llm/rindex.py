"""A run-length index: run-compressed Burrows-Wheeler transform with sampled run ends.

Built over many short texts at once. It keeps one entry per run of the
transform (head, first row, heads of its kind before it) and the text
positions of each run's first and last row; that is enough to step backwards
through the text (LF) and to stream matching statistics: while the next byte
agrees with the run it steps on, otherwise it moves to the nearest run end with
that byte, whose text position is sampled, and shortens the match to what the
two positions have in common.
"""

from __future__ import annotations

import numpy as np

SEPARATOR = 0xFF  # never part of UTF-8


def _ranks(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per value how many are smaller, and the places of the values that are not alone."""
    _, inverse, count = np.unique(values, return_inverse=True, return_counts=True)
    return (np.cumsum(count) - count)[inverse], np.flatnonzero(count[inverse] > 1)


class RunLengthIndex:
    """Index of ``texts`` (bytes without 0xFF). ``length`` is the longest match that matters."""

    def __init__(self, texts: list[bytes], length: int):
        self.length = length
        joined = b"".join(t + b"\xff" for t in texts)
        text = np.frombuffer(joined, np.uint8)
        n = len(text)
        self.text = np.concatenate([text, np.full(length, SEPARATOR, np.uint8)])
        stops = np.flatnonzero(text == SEPARATOR)
        owner = np.searchsorted(stops, np.arange(n))  # the text of every byte
        left = stops[owner] - np.arange(n)  # bytes up to its end
        # ranks of the first 6 bytes; what follows a text's end does not count, ends rank by text
        wide = np.concatenate([text, np.zeros(6, np.uint8)])
        key = np.zeros(n, np.int64)
        for j in range(6):
            key = (key << 8) | np.where(j <= left, wide[j : j + n], 0)
        ends = np.where(left < 6, owner + 1, 0)
        if len(texts) < 1 << 15:
            rank, tied = _ranks((key << 15) | ends)
        else:
            rank, _ = _ranks(key)
            rank, tied = _ranks(rank * (len(texts) + 1) + ends)
        by = {6: rank}
        step = 6
        times = 3 if (n + 1) ** 3 < 1 << 63 else 2  # ranks that fit into one key
        while len(tied):  # only rows that are not yet told apart
            old = rank[tied]
            key = old
            for t in range(1, times):
                far = rank[np.minimum(tied + t * step, n - 1)] + 1
                key = key * (n + 1) + np.where(left[tied] >= t * step, far, 0)
            order = np.argsort(key, kind="stable")
            key, old = key[order], old[order]
            at = np.arange(len(order))
            part = np.maximum.accumulate(np.where(np.diff(key, prepend=-1) != 0, at, 0))
            whole = np.maximum.accumulate(np.where(np.diff(old, prepend=-1) != 0, at, 0))
            rank = rank.copy()
            rank[tied[order]] = old + part - whole
            alone = np.bincount(part, minlength=len(part))[part] == 1
            tied = tied[order[~alone]]
            step *= times
            if step <= length:
                by[step] = rank
        sa = np.empty(n, np.int64)
        sa[rank] = np.arange(n)
        # rows whose first ``length`` bytes are equal are neighbours: number these classes
        some = max(s for s in by if s <= length)
        same = np.ones(n - 1, bool)
        for shift in {*range(0, length - some, some), length - some}:  # together they cover all of it
            part = by[some][np.minimum(sa + shift, n - 1)]
            same &= part[1:] == part[:-1]
        whole = left[sa] >= length
        self.class_of_row = np.concatenate([[0], np.cumsum(~(same & whole[1:] & whole[:-1]))])
        self.row_text = owner[sa]
        bwt = text[sa - 1]  # row of position 0 takes the last byte, an end
        first = np.concatenate([[0], np.flatnonzero(np.diff(bwt)) + 1])
        self.first, self.head = first, bwt[first].astype(np.int64)
        last = np.append(first[1:], n) - 1
        self.last = last
        self.sample_first, self.sample_last = sa[first], sa[last]
        size = last - first + 1
        # rows of equal heads before each run, and where rows of each byte begin
        order = np.argsort(self.head, kind="stable")
        upto = np.cumsum(size[order]) - size[order]
        self.lf = np.empty(len(first), np.int64)
        self.lf[order] = upto  # LF of a run's first row: all rows of smaller bytes, then of this byte
        self.key = self.head[order] * len(first) + order  # runs by (head, place)
        self.order = order
        self.n = n

    def forget_rows(self) -> None:
        """Drop what is kept per row of the transform; the runs and their samples are enough to stream."""
        del self.class_of_row, self.row_text

    def _common(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Length of the common prefix of the text at ``a`` and ``b``, at most ``most``."""
        span = np.arange(self.length)
        limit = len(self.text) - 1
        x = self.text[np.minimum(a[:, None] + span, limit)]
        differ = x != self.text[np.minimum(b[:, None] + span, limit)]
        differ |= x == SEPARATOR
        return np.minimum(np.where(differ.any(axis=1), differ.argmax(axis=1), self.length), most)

    def matching_statistics(self, patterns: list[bytes]):
        """Yields, from the last byte of all patterns to the first, ``(which, place, row, match)``:
        the longest match (up to ``length``) of each pattern at a place, and a row that begins with it."""
        sizes = np.array([len(p) for p in patterns], np.int64)
        text = np.frombuffer(b"".join(patterns), np.uint8).astype(np.int64)
        begin = np.cumsum(sizes) - sizes
        row = np.zeros(len(patterns), np.int64)
        at = np.full(len(patterns), self.sample_first[0], np.int64)
        match = np.zeros(len(patterns), np.int64)
        by_size = np.argsort(-sizes, kind="stable")
        rising = np.sort(sizes)
        for step in range(int(sizes.max(initial=0))):
            which = by_size[: len(sizes) - int(np.searchsorted(rising, step, "right"))]
            c = text[begin[which] + sizes[which] - 1 - step]
            r, a, m = row[which], at[which], match[which]
            run = np.searchsorted(self.first, r, "right") - 1
            jump = np.flatnonzero(self.head[run] != c)
            if len(jump):
                cj = c[jump]
                k = np.searchsorted(self.key, cj * len(self.first) + run[jump])
                below, above = np.maximum(k - 1, 0), np.minimum(k, len(self.key) - 1)
                has_b = (k > 0) & (self.key[below] // len(self.first) == cj)
                has_a = (k < len(self.key)) & (self.key[above] // len(self.first) == cj)
                rb, ra = self.order[below], self.order[above]
                lb = np.where(has_b, self._common(a[jump], self.sample_last[rb], m[jump]), -1)
                la = np.where(has_a, self._common(a[jump], self.sample_first[ra], m[jump]), -1)
                down = lb >= la
                run[jump] = np.where(down, rb, ra)
                r[jump] = np.where(down, self.last[rb], self.first[ra])
                a[jump] = np.where(down, self.sample_last[rb], self.sample_first[ra])
                m[jump] = np.maximum(lb, la)
            gone = m < 0  # the byte is nowhere in the text
            r = np.where(gone, 0, self.lf[run] + r - self.first[run])
            a = np.where(gone, self.sample_first[0], a - 1)
            m = np.where(gone, 0, np.minimum(m + 1, self.length))
            row[which], at[which], match[which] = r, a, m
            yield which, sizes[which] - 1 - step, r, m
