"""Token counts of sections, by attributing the tokens of whole documents.

A document is encoded once, as a whole, with a byte-level vocabulary, so the
lengths of its tokens' byte strings give the span of every token. The token
spans are interval-joined to the document's sections (sorted spans, binary
search). A token that lies in one section counts there; a token that crosses a
boundary is given to one section by a stated rule:

* ``majority``: the section with most of the token's bytes, the first of equals
  (outside only if more bytes lie outside than in any section);
* ``first``: the section that holds the token's first byte;
* ``last``: the section that holds its last byte.

Bytes outside all sections form section ``-1`` (only listed where it gets a
token), so the tokens of a document always add up to the whole.

Defined results: a NULL or empty text has no tokens and its sections count 0;
without sections all tokens go to ``-1``; sections that overlap raise an error; an
empty section gets no token, and a NULL section, or one with a NULL bound, is an empty
one at 0; repeated rows are separate documents.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_arrow, worker_cache
from .textkernel import BLANK, runs, text_bytes

RULES = ("majority", "first", "last")


_END = np.isin(np.arange(256), list(b".!?"))


def sentence_sections(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte spans of the sentences of ``text``, without the blanks around them.

    A sentence ends after ``.``, ``!`` or ``?`` before a blank, and with the line.
    """
    raw = np.frombuffer(text, np.uint8)
    solid = np.flatnonzero(~BLANK[raw])
    if not len(solid):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    stop = raw == 0x0A
    stop[:-1] |= _END[raw[:-1]] & BLANK[raw[1:]]
    stop[-1] = True
    ends = np.flatnonzero(stop) + 1
    upto = np.searchsorted(solid, ends)  # solid bytes before each end
    first = np.concatenate([[0], upto[:-1]])
    full = upto > first
    return solid[first[full]], solid[upto[full] - 1] + 1


def attribute(token_ends: np.ndarray, starts: np.ndarray, ends: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """For sorted, disjoint sections ``[starts, ends)`` and adjoining tokens that end at
    ``token_ends``: the section of every token (-1: outside), and whether it crosses a boundary."""
    token_starts = np.concatenate([[0], token_ends[:-1]]).astype(np.int64)
    if not len(starts):
        return np.full(len(token_ends), -1, np.int64), np.zeros(len(token_ends), bool)

    def section(at: np.ndarray) -> np.ndarray:
        i = np.searchsorted(starts, at, "right") - 1
        return np.where((i >= 0) & (at < ends[np.maximum(i, 0)]), i, -1)

    first, last = section(token_starts), section(token_ends - 1)
    # a token inside one section has both ends there; outside, no section may begin within it
    begun = np.searchsorted(starts, token_ends - 1, "right") - np.searchsorted(starts, token_starts, "right")
    cross = (first != last) | (first == -1) & (begun > 0)
    if rule == "first":
        return first, cross
    if rule == "last":
        return last, cross
    at = np.flatnonzero(cross)
    a, b = token_starts[at], token_ends[at]
    lo, hi = np.searchsorted(ends, a, "right"), np.searchsorted(starts, b, "left")
    outside, most, best = b - a, np.zeros(len(at), np.int64), np.full(len(at), -1, np.int64)
    for k in range(int((hi - lo).max(initial=0))):  # the k-th section that a token touches
        s = np.minimum(lo + k, len(starts) - 1)
        share = np.where(lo + k < hi, np.minimum(ends[s], b) - np.maximum(starts[s], a), 0)
        outside = outside - share
        best = np.where(share > most, s, best)
        most = np.maximum(share, most)
    out = first.copy()
    out[at] = np.where(most >= outside, best, -1)
    return out, cross


_encoders: dict[str, tuple] = worker_cache()


def _encoder(path: str, pattern: str):
    """The task's encoder and the byte length of every token."""
    if path not in _encoders:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        size = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, i in ranks.items():
            size[i] = len(token)
        _encoders[path] = (
            tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}),
            size,
        )
    return _encoders[path]


def _bounds(section: dict | None) -> tuple[int, int]:
    """Start and end of a given section; one that is NULL, or has a NULL bound, is empty."""
    if section is None or section["start"] is None or section["end"] is None:
        return 0, 0
    return section["start"], section["end"]


def _count(path: str, pattern: str, rule: str, given: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    enc, size = _encoder(path, pattern)
    for batch in batches:
        for run in runs(batch):
            buf, off = text_bytes(run.column("text"))
            raw = buf.tobytes()
            sections = run.column("sections").to_pylist() if given else None
            cols: list[list[np.ndarray]] = [[] for _ in range(6)]
            for i in range(run.num_rows):
                text = raw[off[i] : off[i + 1]]
                ids = enc.encode_ordinary(text.decode()) if text else []
                ends = np.cumsum(size[np.array(ids, np.int64)]) if ids else np.empty(0, np.int64)
                # code points before every byte, to give and take spans in characters
                chars = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
                if sections is None:
                    a, b = sentence_sections(text)
                else:
                    spans = sorted((*_bounds(x), k) for k, x in enumerate(sections[i] or ()))
                    byte = np.append(np.flatnonzero(np.diff(chars)), len(text))
                    a, b = (byte[np.clip([s[j] for s in spans], 0, len(byte) - 1).astype(np.int64)] for j in (0, 1))
                    order = np.array([s[2] for s in spans], np.int64)
                    b = np.maximum(a, b)
                real = b > a  # an empty section gets no token
                if (a[real][1:] < b[real][:-1]).any():
                    raise ValueError(f"sections of a document overlap: {[s[:2] for s in spans]}")
                to, cross = attribute(ends, a[real], b[real], rule)
                place = np.flatnonzero(real)
                to = np.where(to >= 0, place[np.maximum(to, 0)] if len(place) else -1, -1)
                got = np.bincount(to + 1, minlength=len(a) + 1)
                over = np.bincount(to + 1, weights=cross, minlength=len(a) + 1).astype(np.int64)
                names = np.arange(len(a)) if sections is None else order
                spot = (0, 1) if got[0] else (1, 1)
                k = len(a) + 1 - spot[0]
                for c, v in zip(
                    cols,
                    (
                        np.full(k, i),
                        np.concatenate([[-1], names])[spot[0] :],
                        np.concatenate([[-1], chars[a]])[spot[0] :],
                        np.concatenate([[-1], chars[b]])[spot[0] :],
                        got[spot[0] :],
                        over[spot[0] :],
                    ),
                    strict=True,
                ):
                    c.append(v.astype(np.int64))
            row, *rest = (np.concatenate(c) if c else np.empty(0, np.int64) for c in cols)
            yield pa.RecordBatch.from_arrays(
                [run.column("doc_id").take(pa.array(row)), *map(pa.array, rest)],
                names=["doc_id", "section", "start", "end", "n_tokens", "n_crossing"],
            )


def section_tokens(docs: DataFrame, vocabulary: str, pattern: str, rule: str = "majority") -> DataFrame:
    """``doc_id, section, start, end, n_tokens, n_crossing`` per section of every document.

    ``docs(doc_id, text[, sections])``: ``sections`` is an array of structs with
    ``start`` and ``end`` in code points (end exclusive), in any order, and
    ``section`` is a place in it; without that column the sections are the
    sentences of the text. ``n_crossing`` counts those of a section's tokens that
    cross a boundary. There is no shuffle: a document's spans are joined where
    it is encoded, so a hot source or long document moves nothing.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    given = "sections" in docs.columns
    out = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType)])
    for name in ("section", "start", "end", "n_tokens", "n_crossing"):
        out = out.add(name, T.LongType())
    counter = functools.partial(_count, vocabulary, pattern, rule, given)
    return map_arrow(docs.select("doc_id", "text", *(["sections"] if given else [])), counter, out)


def document_tokens(sections: DataFrame) -> DataFrame:
    """Totals per document from :func:`section_tokens` (documents without a row have no tokens)."""
    return sections.groupBy("doc_id").agg(
        F.sum("n_tokens").alias("n_tokens"),
        F.count_if(F.col("section") >= 0).alias("n_sections"),
        F.sum("n_crossing").alias("n_crossing"),
    )
