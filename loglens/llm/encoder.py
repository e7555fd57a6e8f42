"""Encoding whole texts with a tokenizer that drops blanks.

Words repeat far more often than texts, so a task cuts all its texts into
pieces, lets the library encode every piece that it has not met yet, and puts
the ids together by array lookups. A cut is made only where no token and no
rule of the tokenizer can reach across: at ASCII blanks, and between an ASCII
letter or digit and an ASCII sign (the apostrophe excepted). Words of the
letters a-z go to the tokenizer's model directly if the steps before it leave
them as they are. Texts that hold one of the tokenizer's special strings are
encoded whole.
"""

from __future__ import annotations

import unicodedata

import numpy as np

from .common import worker_cache
from .textkernel import BLANK, LOWER, U64, span_hashes

# The pieces remembered by a task; beyond it the memory starts anew.
# Texts are encoded in runs of about this many bytes: new pieces are learnt per run.
ENCODE_BYTES = 2 << 20
MAX_PIECES = 1_500_000
# Between two tasks a worker process keeps a memory of at most this many pieces (some 40 bytes each).
KEPT_PIECES = 500_000
JOINED = 512


def _classes() -> np.ndarray:
    """0: blank or anything that must not be cut off, 1: letter or digit, 2: sign."""
    out = np.zeros(256, np.uint8)
    for c in range(0x21, 0x7F):
        out[c] = 1 if chr(c).isalnum() else 2
    out[ord("'")] = 0
    return out


CLASS = _classes()
# letters of plain words, and the blank that is put between them
PLAIN = np.zeros(256, bool)
PLAIN[[0x20, *range(0x61, 0x7B)]] = True


def _fast(tok, texts: list[str]) -> list[np.ndarray]:
    """Ids of each text; the library leaves out the places in the text."""
    return [np.array(e.ids, np.uint32) for e in tok.encode_batch_fast(texts, add_special_tokens=False)]


class PieceEncoder:
    """Encodes many texts at once; equal to the library's ``encode`` on each whole text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        if self.ids("a b,c") != [*self.ids("a"), *self.ids("b"), *self.ids(","), *self.ids("c")]:
            raise ValueError("this tokenizer encodes blanks; its texts can't be cut at them")
        self.special = [t.content.lower().encode() for t in self.tok.get_added_tokens_decoder().values()]
        size = self.tok.get_vocab_size()
        self.ends = np.zeros(size, bool)
        for token, i in self.tok.get_vocab().items():
            self.ends[i] = token.endswith("</w>")
        self.words = self._plain_words()
        self.forget()

    def _plain_words(self):
        """The tokenizer's model without the steps before it, if these leave words of the letters a-z as they are."""
        from tokenizers import Tokenizer, pre_tokenizers

        letters = [chr(c) for c in range(0x61, 0x7B)]
        word = "".join(a + b for a in letters for b in letters)  # every letter beside every other
        normal = self.tok.normalizer.normalize_str(word) if self.tok.normalizer else word
        if not self.tok.pre_tokenizer or normal != word or [w for w, _ in self.tok.pre_tokenizer.pre_tokenize_str(word)] != [word]:
            return self.tok
        words = Tokenizer(self.tok.model)
        words.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        return words

    def ids(self, text: str) -> list[int]:
        return self.tok.encode(text, add_special_tokens=False).ids

    def forget(self) -> None:
        self.keys = np.empty(0, U64)
        self.at = np.empty(0, np.int64)
        self.len = np.empty(0, np.int64)
        self.flat = np.empty(1 << 16, np.uint32)
        self.used = 0

    def end_task(self) -> None:
        """A worker process lives on and serves other tasks: it keeps a small memory, no large one."""
        if len(self.keys) > KEPT_PIECES:
            self.forget()

    def _encode_pieces(self, low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the pieces of ``low`` at these places, where those of each piece begin, and how many each has."""
        step = ends - starts + 1
        to = np.cumsum(step)
        at = to - step
        # all pieces end to end, a blank behind each
        index = np.arange(to[-1])
        index += np.repeat(starts - at, step)
        text = low[np.minimum(index, len(low) - 1, out=index)]
        text[to - 1] = 0x20
        # words of plain letters end in a word-end token: many are encoded in one call
        plain = np.logical_and.reduceat(PLAIN[text], at)
        latin = np.zeros(len(starts), bool)
        pieces = {int(i): text[at[i] : to[i] - 1].tobytes().decode() for i in np.flatnonzero(~plain)}
        for i, p in pieces.items():
            latin[i] = p.isalpha() and max(p) < "ɐ" and p == p.lower() and unicodedata.is_normalized("NFC", p)
        counts = np.zeros(len(starts), np.int64)
        order, found, odd = [], [], [np.flatnonzero(~(plain | latin))]
        for tok, of in ((self.words, plain), (self.tok, latin)):
            words, letters = np.flatnonzero(of), text[np.repeat(of, step)]
            end = np.cumsum(step[words])
            for i in range(0, len(words), JOINED):
                some = words[i : i + JOINED]
                joined = letters[end[i] - step[some[0]] : end[i + len(some) - 1] - 1]
                ids = _fast(tok, [joined.tobytes().decode()])[0]
                last = np.flatnonzero(self.ends[ids]) + 1
                if len(last) == len(some) and last[-1] == len(ids):
                    counts[some] = np.diff(last, prepend=0)
                    order.append(some)
                    found.append(ids)
                else:
                    odd.append(some)
        rest = np.sort(np.concatenate(odd))
        own = _fast(self.tok, [pieces.get(int(j)) or text[at[j] : to[j] - 1].tobytes().decode() for j in rest])
        counts[rest] = [len(x) for x in own]
        order = np.concatenate([*order, rest])
        place = np.empty(len(starts), np.int64)
        place[order] = np.cumsum(counts[order]) - counts[order]
        return np.concatenate([*found, *own]), place, counts

    def _learn(self, keys: np.ndarray, low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """Remember new pieces (``keys`` ascending)."""
        ids, at, counts = self._encode_pieces(low, starts, ends)
        need = self.used + len(ids)
        if need > len(self.flat):
            self.flat = np.concatenate([self.flat[: self.used], np.empty(max(need, 2 * len(self.flat)) - self.used, np.uint32)])
        self.flat[self.used : need] = ids
        at += self.used
        self.used = need
        place = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, place, keys)
        self.at = np.insert(self.at, place, at)
        self.len = np.insert(self.len, place, counts)

    def encode(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and the number of ids of each text."""
        low = LOWER[buf]
        raw = low.tobytes()
        whole = [
            t
            for t in (range(len(off) - 1) if any(s in raw for s in self.special) else ())
            if any(s in raw[off[t] : off[t + 1]] for s in self.special)
        ]
        n_texts = len(off) - 1
        if not len(buf):
            return np.empty(0, np.uint32), np.zeros(n_texts, np.int64)
        word, kind = ~BLANK[low], CLASS[low]
        edge = np.zeros(len(low) + 1, bool)
        edge[off] = True
        border = edge[1:-1] | (kind[1:] + kind[:-1] == 3) & (kind[1:] != 0) & (kind[:-1] != 0)
        first, last = word.copy(), word.copy()
        first[1:] &= ~word[:-1] | border
        last[:-1] &= ~word[1:] | border
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        keys, index, back = np.unique(span_hashes(low, starts), return_index=True, return_inverse=True)
        if len(self.keys) > MAX_PIECES:
            self.forget()
        place = np.searchsorted(self.keys, keys)
        known = place < len(self.keys)
        known[known] = self.keys[place[known]] == keys[known]
        if not known.all():
            new = np.flatnonzero(~known)
            self._learn(keys[new], low, starts[index[new]], ends[index[new]])
            place = np.searchsorted(self.keys, keys)
        counts = self.len[place][back]
        total = int(counts.sum())
        ids = self.flat[np.arange(total) + np.repeat(self.at[place][back] - (np.cumsum(counts) - counts), counts)]
        upto = np.concatenate([[0], np.cumsum(counts)])[np.searchsorted(starts, off)]
        per = np.diff(upto)
        if whole:
            parts = np.split(ids, upto[1:-1])
            for t in whole:
                parts[t] = np.array(self.ids(buf[off[t] : off[t + 1]].tobytes().decode()), np.uint32)
                per[t] = len(parts[t])
            ids = np.concatenate(parts)
        return ids, per


def with_end(ids: np.ndarray, per: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Append ``end_id`` to the ids of every text."""
    out = np.full(len(ids) + len(per), end_id, np.uint32)
    out[np.arange(len(ids)) + np.repeat(np.arange(len(per)), per)] = ids
    return out, per + 1


_encoders: dict[str, PieceEncoder] = worker_cache()


def piece_encoder(path: str) -> PieceEncoder:
    """The task's encoder for the tokenizer file ``path``."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]
