"""Token blocks, run-length index, chunks and the similarity join against brute force."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from loglens.llm import chunks, components, jaccard, queries, rans, suffix_dedup, tokens_binary
from loglens.llm.encoder import PieceEncoder
from loglens.llm.rindex import RunLengthIndex
from loglens.llm.textkernel import text_bytes
from loglens.session import fresh_path

PATH = queries.tokenizer_path()


@pytest.mark.parametrize("n", [0, 1, 511, 512, 5000, 300_000])
def test_rans_round_trip_whole_and_by_part(n):
    r = np.random.default_rng(n)
    ids = np.minimum(r.zipf(1.3, n), 49_000).astype(np.uint32)
    freq, bits = rans.quantize(np.bincount(ids, minlength=3))
    assert n == 0 or freq.sum() == 1 << bits
    table = rans.Table(freq, bits)
    block = rans.encode(ids, table, 512, 64)
    assert (rans.decode(block, table) == ids).all()
    parts = [rans.decode(block, table, p) for p in range(rans.checkpoints(block))]
    assert (np.concatenate([np.empty(0, np.uint32), *parts]) == ids).all()
    if n > 5000:
        entropy = -(np.bincount(ids)[ids] / n).clip(1e-12)
        assert len(block) * 8 < 1.2 * n * np.mean(-np.log2(-entropy)) + 64 * 512 * 4


ODD_TEXTS = [
    "it's <|endoftext|> A<|EndOfText|>b x≠y É É don't!!— ﬁ ½ 日本語 ​א\x1c a　b 12ab3 --é",
    "", " ", "<|startoftext|><|endoftext|>", "I'LL we've'd 's", "a.b,c;d" * 50, "ÀÉ́ß İ ŉ", "😀👍🏽 ok", "x" * 3000, "\x00\x01 a\x7fb",
]


def test_pieces_encode_like_whole_texts():
    import pyarrow as pa

    enc = PieceEncoder(PATH)
    for texts in (ODD_TEXTS, [t + " plain words" for t in ODD_TEXTS if "<|" not in t], ODD_TEXTS[::-1]):
        ids, per = enc.encode(*text_bytes(pa.array(texts)))
        assert [x.tolist() for x in np.split(ids, np.cumsum(per)[:-1])] == [enc.ids(t) for t in texts]


def test_new_plain_words_cost_no_call_each():
    import sys

    import pyarrow as pa

    r = random.Random(5)
    words = ["".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=r.randint(1, 12))) for _ in range(4000)]
    enc = PieceEncoder(PATH)
    texts = [" ".join(words), "", "Plain 12 É日 " + words[7]]
    buf, off = text_bytes(pa.array(texts))
    calls = 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        ids, per = enc.encode(buf, off)
    finally:
        sys.setprofile(None)
    assert calls < len(set(words)) / 2
    assert [x.tolist() for x in np.split(ids, np.cumsum(per)[:-1])] == [enc.ids(t) for t in texts]


def test_words_without_a_word_end_are_encoded_alone():
    import pyarrow as pa

    enc = PieceEncoder(PATH)
    texts = ["one two three, été naïve straße 7up", "four one", "été, 日本 two"]
    want = [enc.ids(t) for t in texts]
    enc.ends[:] = False  # no joined call can be told apart
    for _ in range(2):  # learnt, then remembered
        ids, per = enc.encode(*text_bytes(pa.array(texts)))
        assert [x.tolist() for x in np.split(ids, np.cumsum(per)[:-1])] == want


def test_plain_words_by_the_model_and_by_the_tokenizer():
    r = random.Random(8)
    words = ["".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=r.randint(1, 15))) for _ in range(3000)]
    enc = PieceEncoder(PATH)
    assert enc.words is not enc.tok
    assert enc.words.encode(" ".join(words)).ids == enc.ids(" ".join(words))
    # a tokenizer that changes letters gets its words itself
    from tokenizers import normalizers

    enc.tok.normalizer = normalizers.Sequence([enc.tok.normalizer, normalizers.Replace("ab", "ba")])
    assert enc._plain_words() is enc.tok


def test_a_worker_keeps_a_small_memory_of_pieces(monkeypatch):
    import pyarrow as pa

    from loglens.llm import encoder

    enc = encoder.piece_encoder(PATH)
    enc.forget()
    text = pa.RecordBatch.from_pydict({"part": [0, 0], "doc_id": [1, 2], "text": ["some words here", None]})
    first = list(tokens_binary._encode(PATH, 2, iter([text])))
    assert len(enc.keys) == 3
    assert list(tokens_binary._encode(PATH, 2, iter([text]))) == first
    monkeypatch.setattr(encoder, "KEPT_PIECES", 2)
    assert list(tokens_binary._encode(PATH, 2, iter([text]))) == first
    assert len(enc.keys) == 0


def test_token_blocks_of_odd_documents(spark, odd_docs, odd_rows, no_docs):
    enc = PieceEncoder(PATH)
    path = tokens_binary.write_tokens(spark, odd_docs, fresh_path(spark, "t"), PATH, 2)
    rows = sorted(tokens_binary.read_tokens(spark, path).collect(), key=lambda r: r.start)
    want = sorted((str(i), tuple(enc.ids(t or "") + [2])) for i, t, *_ in odd_rows)
    assert sorted((str(r.doc_id), tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in rows) == want
    at = 0
    for r in rows:
        assert r.start == at and len(r.ids) == 4 * r.n_tokens
        at += r.n_tokens
    ids = [r.doc_id for r in rows]
    assert ids[0] is None and ids[1:] == sorted(ids[1:])
    empty = tokens_binary.write_tokens(spark, no_docs, fresh_path(spark, "t"), PATH, 2)
    assert tokens_binary.read_tokens(spark, empty).collect() == []


def test_a_damaged_block_is_noticed(spark, odd_docs):
    path = tokens_binary.write_tokens(spark, odd_docs, fresh_path(spark, "t"), PATH, 2)
    blocks = spark.read.parquet(f"{path}/blocks").toArrow().to_pylist()
    assert all(zlib.crc32(b["payload"]) == b["crc32"] for b in blocks)
    out = fresh_path(spark, "t")
    spark.read.parquet(f"{path}/table").write.parquet(f"{out}/table")
    spark.read.parquet(f"{path}/blocks").selectExpr(
        "part", "first_token", "doc_ids", "n_tokens", "crc32 + 1 AS crc32", "payload"
    ).write.parquet(f"{out}/blocks")
    with pytest.raises(Exception, match="checksum"):
        tokens_binary.read_tokens(spark, out).collect()


def test_matching_statistics_against_brute_force():
    for seed in range(30):
        r = random.Random(seed)
        letters = b"ab" if seed % 2 else b"abcd"
        make = lambda a, b, s: bytes(r.choice(s) for _ in range(r.randint(a, b)))  # noqa: B023, E731
        texts = [make(1, 30, letters) for _ in range(r.randint(1, 12))]
        length = r.choice([8, 9, 10, 13])
        index = RunLengthIndex(texts, length)
        patterns = [make(0, 25, letters + b"z") for _ in range(8)] + texts
        for which, place, rows, match in index.matching_statistics(patterns):
            for w, p, row, m in zip(which.tolist(), place.tolist(), rows.tolist(), match.tolist(), strict=True):
                best = 0
                while best < length and p + best < len(patterns[w]) and any(patterns[w][p : p + best + 1] in t for t in texts):
                    best += 1
                assert m == best
                if m == length:
                    same = index.class_of_row == index.class_of_row[row]
                    assert set(index.row_text[same].tolist()) == {i for i, t in enumerate(texts) if patterns[w][p : p + length] in t}


def brute_removal(rows):
    first: dict = {}
    key = lambda i: -(2**63) if i is None else i
    docs = [(key(i), (t or "").encode()) for i, t, *_ in rows]
    for i, raw in sorted(docs):
        for p in range(len(raw) - 49):
            first.setdefault(raw[p : p + 50], i)
    out = []
    for i, raw in docs:
        gone = bytearray(len(raw))
        for p in range(len(raw) - 49):
            if first[raw[p : p + 50]] < i:
                gone[p : p + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(raw, gone, strict=True) if not g)
        runs = sum(1 for k in range(len(raw)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def test_repeated_strings_of_odd_documents(spark, odd_docs, odd_rows, no_docs):
    got = suffix_dedup.removal_digest(spark, odd_docs).collect()
    want = brute_removal(odd_rows)
    low = -(2**63)
    assert sorted((low if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == want
    kept = suffix_dedup.remove_repeats(spark, odd_docs).collect()
    assert sorted(hashlib.sha256(r.kept or b"").hexdigest() for r in kept) == sorted(w[4] for w in want)
    assert suffix_dedup.removal_digest(spark, no_docs).collect() == []


def test_crowded_names_and_full_bit_table_change_nothing(spark, odd_docs, odd_rows):
    want = {(i, n, r) for i, _, n, r, _ in brute_removal(odd_rows) if n}
    for given in ({"hot": 1}, {"bits": 1 << 15}, {"hot": 2, "bits": 1 << 15}):
        per: dict = {}
        for s in suffix_dedup.repeated_spans(spark, odd_docs, **given).collect():
            per.setdefault((s.doc_id, s.mark), []).append({"start": s.start, "end": s.end})
        got = set()
        for (i, _), spans in per.items():
            joined = suffix_dedup._join_spans(spans)
            got.add((-(2**63) if i is None else i, sum(b - a for a, b in joined), len(joined)))
        assert got == want, given


def test_long_periodic_stretches_are_not_left_to_one_task(spark, monkeypatch):
    r = random.Random(4)
    rows = [(i, "".join(r.choice("xyz") for _ in range(80)) + "=-" * (1500 + 100 * i) + f" end {i}") for i in range(6)]
    docs = spark.createDataFrame([*rows, (None, "=-" * 40)], "doc_id long, text string").repartition(3)
    hot, kept = [], suffix_dedup.save

    def spy(spark, df, name):
        out = kept(spark, df, name)
        if name == "suffix-hot":
            hot.append(out.count())
        return out

    monkeypatch.setattr(suffix_dedup, "save", spy)
    want = {(i, n, k) for i, _, n, k, _ in brute_removal([*rows, (None, "=-" * 40)]) if n}
    for given in ({"hot_windows": 5000}, {}):
        per: dict = {}
        for s in suffix_dedup.repeated_spans(spark, docs, **given).collect():
            per.setdefault(s.doc_id, []).append({"start": s.start, "end": s.end})
        joined = {i: suffix_dedup._join_spans(spans) for i, spans in per.items()}
        assert {(i, sum(b - a for a, b in j), len(j)) for i, j in joined.items()} == want
    assert hot[0] > 0 and hot[1] == 0


def test_chunks_of_odd_documents(spark, odd_docs, odd_rows, no_docs):
    rows = chunks.dedup_chunks(spark, odd_docs).collect()
    assert len(rows) == len(odd_rows)
    by = {r.doc_id: r for r in rows}
    assert by[2].n_removed == by[2].n_bytes and by[2].kept == b"" and by[1].n_removed == 0
    assert by[10].n_removed > 0.3 * by[10].n_bytes  # shares its first half with a smaller document
    assert 0 < by[3].n_removed < by[3].n_bytes
    assert by[4].kept is None and by[5].kept == b""
    assert all(len(r.kept or b"") == r.n_bytes - r.n_removed for r in rows)
    assert chunks.dedup_chunks(spark, no_docs).collect() == []


def brute_chunks(rows):
    """Every document's removal, from the chunks of ``chunks.borders`` and the first place of each text."""
    placed, first = [], {}
    for i, t in rows:
        raw = (t or "").encode()
        ends, _ = chunks.borders(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        at = [0, *ends.tolist()]
        placed.append((i, t, raw, list(zip(at, at[1:], strict=False))))
    marks = dict(zip([t for _, t in rows], xxhash([t for _, t in rows]), strict=True))
    place = lambda i, t, a: (i is not None, i or 0, marks[t], a)
    for i, t, raw, pieces in placed:
        for a, b in pieces:
            first[raw[a:b]] = min(first.get(raw[a:b], (True, 2**63, 0, 0)), place(i, t, a))
    out = []
    for i, t, raw, pieces in placed:
        gone = [place(i, t, a) != first[raw[a:b]] for a, b in pieces]
        kept = b"".join(raw[a:b] for (a, b), g in zip(pieces, gone, strict=True) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((str(i), len(raw), len(raw) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def xxhash(texts):
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k long, t string").selectExpr("k", "xxhash64(t) AS h")
    return [r.h for r in sorted(rows.collect(), key=lambda r: r.k)]


def test_chunks_against_brute_force(spark, odd_rows):
    r = random.Random(12)
    parts = [" ".join(f"t{p}x{r.randint(0, 99)}" for _ in range(r.randint(20, 200))) for p in range(9)]
    rows = [(i, t) for i, t, *_ in odd_rows]
    for i in range(40):
        rows.append((200 + i % 30, "\n".join(r.choice(parts)[r.choice([0, 0, 37]) :] for _ in range(r.randint(1, 5)))))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = chunks.dedup_chunks(spark, docs).collect()
    found = sorted((str(x.doc_id), x.n_bytes, x.n_removed, len(x.removed), hashlib.sha256(x.kept or b"").hexdigest()) for x in got)
    assert found == brute_chunks(rows) and any(x.n_removed for x in got)


def test_chunk_borders_move_with_an_insertion():
    text = " ".join(f"word{i * i % 977}" for i in range(4000)).encode()
    changed = text[:9000] + b" inserted " + text[9000:]

    def pieces(t):
        ends, _ = chunks.borders(np.frombuffer(t, np.uint8), np.array([0, len(t)]))
        at = [0, *ends.tolist()]
        assert at[-1] == len(t) and all(b - a <= chunks.MAX_BYTES for a, b in zip(at, at[1:], strict=False))
        return [t[a:b] for a, b in zip(at, at[1:], strict=False)]

    assert len(set(pieces(changed)) - set(pieces(text))) <= 6


def brute_roots(rows):
    """Shingle sets of all rows, and the root row of each row's component."""
    up = {c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    sets = []
    for _, t, *_ in rows:
        w = (t or "").translate(str.maketrans(up)).encode().split()
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    return sets, [find(i) for i in range(len(rows))]


def brute_components(rows):
    sets, roots = brute_roots(rows)
    find = roots.__getitem__
    least: dict = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return sorted((str(r[0]), len(sets[i]), str(least.get(find(i)))) for i, r in enumerate(rows))


def test_similar_documents_against_brute_force(spark, odd_docs, odd_rows, no_docs):
    r = random.Random(9)
    rows = list(odd_rows)
    for g in range(12):  # groups of drifting copies: linked in chains, not all in pairs
        words = [f"w{g}x{k}" for k in range(r.randint(8, 90))]
        for _ in range(6):
            words = [w if r.random() > 0.02 else w + "y" for w in words]
            rows.append((len(rows) + 100, " ".join(words), "x", "s", 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    got = jaccard.similar_documents(spark, docs).collect()
    assert sorted((str(x.doc_id), x.n_shingles, str(x.component_id)) for x in got) == brute_components(rows)
    few = jaccard.similar_documents(spark, docs, slots=jaccard.BLOCK).collect()
    assert sorted((str(x.doc_id), x.component_id) for x in few) == sorted((str(x.doc_id), x.component_id) for x in got)
    with pytest.raises(ValueError, match="power of two"):
        jaccard.frequency_levels(docs, 3 * jaccard.BLOCK)
    kept = jaccard.keep_one(spark, docs)
    assert kept.columns == docs.columns
    sets, roots = brute_roots(rows)
    assert kept.count() == len({r for s, r in zip(sets, roots, strict=True) if s}) + sum(1 for s in sets if not s)
    assert jaccard.similar_documents(spark, no_docs).collect() == []


def test_one_document_of_each_component_stays(spark):
    texts = {c: " ".join(f"{c}{k}" for k in range(30)) for c in "abcdef"}
    rows = [
        (None, texts["a"]), (None, texts["b"]), (None, texts["b"]), (None, texts["b"] + " more"),  # components without a name
        (7, texts["c"]), (7, texts["d"]), (7, texts["d"]),  # one id, two components
        (8, texts["e"]), (None, texts["e"]), (3, texts["e"] + " more"), (9, texts["f"]),
        (None, None), (None, ""), (5, " "),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = [tuple(r) for r in jaccard.keep_one(spark, docs).collect()]
    b = [r for r in kept if r[0] is None and (r[1] or "").startswith("b0")]
    assert len(b) == 1 and b[0] in rows
    rest = [(None, texts["a"]), (7, texts["c"]), (7, texts["d"]), (3, texts["e"] + " more"), (9, texts["f"]), *rows[-3:]]
    assert sorted(map(repr, kept)) == sorted(map(repr, rest + b))


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 80)] + [(300, 300), (401, 400), (400, 401)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {(r.a, r.b) for r in components.components(spark, df).collect()}
    assert got == {(i, 0) for i in range(1, 61)} | {(100 + i, 100) for i in range(1, 80)} | {(401, 400)}


def test_index_finds_what_the_matching_statistics_tell(monkeypatch):
    """Marks against brute force on stretches of a few names, and nothing beyond the smallest document without the statistics."""
    length = suffix_dedup.LENGTH
    without = 0
    for seed in range(12):
        r = random.Random(seed)
        texts, docs, names = [], [], []
        for name in range(r.randint(1, 6)):
            base = bytes(r.choice(b"abcdef") for _ in range(90))
            for _ in range(r.randint(1, 9)):
                a = r.randint(0, 30)
                t = bytearray(base[a : a + r.randint(length, 60)])
                if r.random() < 0.5:
                    t[r.randrange(len(t))] = ord("z")
                texts.append(bytes(t))
                docs.append(r.randint(-3, 9))
                names.append(name)
        doc, name, starts = np.array(docs), np.array(names), np.array([r.randint(0, 500) for _ in docs])

        def marked(found):
            out = [bytearray(len(t)) for t in texts]  # noqa: B023
            for row, a, b in zip(*found, strict=True):
                out[row][a - starts[row] : b - starts[row]] = b"\1" * (b - a)  # noqa: B023
            return out

        want = [bytearray(len(t)) for t in texts]
        for i, t in enumerate(texts):
            for p in range(len(t) - length + 1):
                if any(docs[j] < docs[i] and names[j] == names[i] and t[p : p + length] in texts[j] for j in range(len(texts))):
                    want[i][p : p + length] = b"\1" * length
        assert marked(suffix_dedup.mark_repeats(texts, doc, starts, name)) == want
        with monkeypatch.context() as m:
            m.setattr(RunLengthIndex, "matching_statistics", lambda self, patterns: iter(()))
            without += marked(suffix_dedup.mark_repeats(texts, doc, starts, name)) != want
    assert without >= 8


def test_whole_copies_are_left_out_and_removed(spark, monkeypatch):
    text = " ".join(f"word{k}" for k in range(40))
    rows = [(k, text) for k in range(6)] + [(None, text + " x"), (3, text), (9, "short"), (10, "short"), (11, text + " x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((-(2**63) if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.removal_digest(spark, docs).collect())
    assert got == brute_removal(rows)
    keyed = suffix_dedup._keyed(docs)
    copies = suffix_dedup.whole_copies(spark, keyed)
    assert sorted(r.doc_id for r in copies.collect()) == [1, 2, 3, 3, 4, 5, 11]
    # rows that hit the table of copies by chance are still looked at
    monkeypatch.setattr(suffix_dedup, "DOC_BITS", 1 << 15)
    many = spark.createDataFrame([(k, f"{k} different text number {k} " * 3) for k in range(3000)] + rows, "doc_id long, text string")
    keyed = suffix_dedup._keyed(many)
    copies = suffix_dedup.whole_copies(spark, keyed)
    skipped = suffix_dedup.Skipped(spark, keyed, copies)
    import pyarrow as pa

    marks = [r.mark for r in keyed.select("mark").collect()]
    kept = set(skipped.rest(pa.RecordBatch.from_arrays([pa.array(marks)], names=["mark"])).column("mark").to_pylist())
    gone = {r.mark for r in copies.collect()}
    assert set(marks) - gone <= kept
