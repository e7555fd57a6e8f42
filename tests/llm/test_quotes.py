"""Quotation linking on small hand-made conversations."""

from __future__ import annotations

import random

from loglens.llm import quotes

SCHEMA = "conv_id long, turn long, role string, text string, position string"


def run(spark, rows):
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    return quotes.reply_ordered(spark, df).collect()


def test_nested_quotes_and_reply_order(spark):
    rows = [
        (1, 0, "a", "How do I open the window?\n\nIt is stuck since Monday."),
        (1, 1, "b", "An unrelated remark about lunch."),
        (1, 2, "c", "> how do I open  the window?\nPush it upwards."),
        (1, 3, "a", "> > How do I open the window?\n> Push it upwards.\nThat worked, many thanks!"),
        (1, 4, "b", ">>> How do I open the window?\n>> Push it upwards.\n> That worked, many thanks!\nGlad to hear."),
        (1, 5, "d", "> Never written by anybody here\nWhat?"),
        (2, 0, "d", "> Push it upwards.\nSaw this elsewhere."),
    ]
    out = {(r.conv_id, r.turn): r for r in run(spark, rows)}
    assert [out[1, t].parent_turn for t in range(6)] == [None, None, 0, 2, 3, None]
    assert [out[1, t].thread for t in range(6)] == [0, 1, 0, 0, 0, 5]
    assert [out[1, t].depth for t in range(6)] == [0, 0, 1, 2, 3, 0]
    assert [out[1, t].position for t in range(6)] == [0, 4, 1, 2, 3, 5]
    assert out[1, 4].text == "Glad to hear."
    assert [out[1, t].n_quoted for t in range(6)] == [0, 0, 1, 2, 3, 1]
    assert (out[2, 0].source_conv, out[2, 0].source_turn, out[2, 0].parent_turn) == (1, 2, None)


def test_long_reply_chain(spark):
    rows = [(7, 0, "u", "message number zero of the chain")]
    for t in range(1, 40):
        rows.append((7, t, "u", f"> message number {'zero' if t == 1 else t - 1} of the chain\nmessage number {t} of the chain"))
    out = sorted(run(spark, rows), key=lambda r: r.turn)
    assert [r.depth for r in out] == list(range(40)) and {r.thread for r in out} == {0}
    assert [r.position for r in out] == list(range(40))


def test_nulls_empties_ties(spark):
    rows = [
        (None, 0, "a", "the first words of nobody"),
        (None, 1, "b", "> the first words of nobody\nyes"),
        (3, None, None, None),
        (3, 1, "a", ""),
        (3, 1, "a", ""),
        (3, 2, "b", ">"),
        (4, 1, "a", "> a quotation of what comes later\nx"),
        (4, 2, "a", "a quotation of what comes later"),
    ]
    got = run(spark, rows)
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.conv_id, []).append(r)
    for rs in by.values():
        assert sorted(r.position for r in rs) == list(range(len(rs)))
    assert [r.parent_turn for r in sorted(by[None], key=lambda r: r.turn)] == [None, 0]
    assert all(r.parent_turn is None for r in by[3] + by[4])
    assert run(spark, []) == []


def test_short_units_link_inside_their_conversation(spark):
    rows = [
        (1, 0, "a", "Yes, I agree"),
        (1, 1, "b", "今日は雨です。"),
        (1, 2, "c", "???"),
        (1, 3, "b", "> Yes, I agree\nGood."),
        (1, 4, "b", "> 今日は雨です。\nはい。"),
        (1, 5, "b", "> ? ??\nNothing."),
        (2, 0, "a", "> Yes, I agree\nOf another conversation, so not linked."),
        (None, 0, "a", "no"),
        (None, 1, "a", "> no\nyes"),
    ]
    out = {(r.conv_id, r.turn): r for r in run(spark, rows)}
    assert [out[1, t].parent_turn for t in range(6)] == [None, None, None, 0, 1, 2]
    assert [out[1, t].position for t in range(6)] == [0, 2, 4, 1, 3, 5]
    assert (out[2, 0].source_conv, out[2, 0].source_turn, out[2, 0].parent_turn) == (None, None, None)
    assert out[None, 1].parent_turn == 0 and out[None, 1].source_turn is None


def test_sentences_of_a_passage_are_linked(spark):
    rows = [
        (1, 0, "a", "We met on Monday. The door was locked! Nobody (not even Ann.) had\na key to it. So we left."),
        (1, 1, "b", "雨が降った。「傘がない。」道は暗い！帰ろう。"),
        (1, 2, "c", "A title\nThen a sentence of its own. And more."),
        (1, 3, "d", "> The door was locked!\nWhich one?"),
        (1, 4, "d", "> The door was\n> locked! Nobody (not even Ann.) had a key\n> to it.\nReally?"),
        (1, 5, "d", "> 道は暗い！\nまだ。"),
        (1, 6, "d", "> Then a sentence of its own.\nFine."),
    ]
    out = {r.turn: r for r in run(spark, rows)}
    assert [out[t].parent_turn for t in range(7)] == [None, None, None, 0, 0, 1, 2]
    assert [out[t].depth for t in range(7)] == [0, 0, 0, 1, 1, 1, 1]


def test_generated_quotations_against_brute_force(spark):
    """Messages of sentences nobody else writes; a quotation takes a line, a paragraph or some sentences of one."""
    r = random.Random(3)
    rows, want, n = [], {}, 0
    for conv in range(12):
        own: list[list[list[str]]] = []  # paragraphs of sentences per message
        for turn in range(r.randint(2, 12)):
            quoted, parent = [], None
            if own and r.random() < 0.7:
                parent = r.randrange(len(own))
                part = r.choice(own[parent])
                a = r.randrange(len(part))
                words = " ".join(part[a : r.randint(a + 1, len(part))]).split()
                k = r.randint(1, len(words))
                quoted = ["> " + " ".join(w) for w in (words[:k], words[k:]) if w]
            paragraphs = []
            for _ in range(r.randint(1, 3)):
                paragraphs.append([f"m{n + i}" + r.choice(["", " " + "x" * r.randint(1, 30)]) + r.choice(".!?") for i in range(r.randint(1, 4))])
                n += 4
            own.append(paragraphs)
            rows.append((conv, turn, "a", "\n".join([*quoted, "\n\n".join(" ".join(p) for p in paragraphs)])))
            want[conv, turn] = parent
    out = {(x.conv_id, x.turn): x for x in run(spark, rows)}
    assert {k: x.parent_turn for k, x in out.items()} == want
    for (conv, turn), x in out.items():
        up, depth = turn, 0
        while want[conv, up] is not None:
            up, depth = want[conv, up], depth + 1
        assert (x.thread, x.depth) == (up, depth)
        before = sum((y.thread, y.turn) < (x.thread, x.turn) for (c, _), y in out.items() if c == conv)
        assert x.position == before
