from tillwork.llm import chat
from tillwork.llm.queries import QUERIES

from .plain import clashing

SCHEMA = "conv_id long, turn long, role string, text string"


def order(spark, rows, *extra):
    df = clashing(spark.createDataFrame(rows, SCHEMA), *extra)
    return {(r.conv_id, r.turn): r for r in chat.reply_order(df).collect()}


def test_quotes_are_linked_and_taken_out(spark):
    rows = [
        (1, 0, "user", "Which river is longest?\nI mean in Europe."),
        (1, 1, "assistant", "The Volga."),
        (1, 2, "user", "Thanks.\n\nAnd the widest lake there?"),
        (1, 3, "assistant", "> which  RIVER is longest\nBy drainage it is the Volga as well."),
        (1, 4, "user", "On Monday A wrote:\n> By drainage it is the Volga as well.\n>> Which river is longest?\nGood to know."),
        (1, 5, "user", "> The Volga\n> nobody said this\nSure?"),
        (1, 6, "assistant", "> Sure?\nYes."),
        (2, 0, "user", "> Which river is longest?\nother talk"),
    ]
    got = order(spark, rows, "branch", "level", "own", "chunk")
    look = lambda c, t: (got[c, t].reply_to, got[c, t].quoted_turns, got[c, t].branch, got[c, t].depth)
    assert look(1, 0) == (None, [], 0, 0) and look(1, 1) == (0, [], 0, 1) and look(1, 2) == (1, [], 0, 2)
    assert look(1, 3) == (0, [0], 3, 1)
    assert look(1, 4) == (3, [0, 3], 3, 2)
    assert look(1, 5) == (1, [1], 5, 2)
    assert look(1, 6) == (5, [5], 5, 3)
    assert look(2, 0) == (None, [], 0, 0)
    assert got[1, 3].text == "By drainage it is the Volga as well." and got[1, 4].text == "Good to know." and got[2, 0].text == "other talk"
    assert got[1, 0].text == rows[0][3]


def test_whole_messages_and_paragraphs_match_when_wrapped_anew(spark):
    rows = [(7, 0, "user", "First part of the plan.\nSecond part of the plan.\n\nAnother paragraph\nof two lines."), (7, 1, "assistant", "fine"),
            (7, 2, "user", "> First part of the\n> plan. Second part of the plan.\nAgreed."),
            (7, 3, "user", "> Another paragraph of\n> two lines\nAlso.")]
    got = order(spark, rows)
    assert got[7, 2].reply_to == 0 and got[7, 3].reply_to == 0 and got[7, 3].branch == 3 and got[7, 3].depth == 1


def test_the_latest_earlier_source_counts_and_most_words_win(spark):
    rows = [(1, 0, "u", "yes\nlong line of many words here"), (1, 1, "u", "yes"), (1, 2, "u", "no"),
            (1, 3, "u", "> yes\na"), (1, 4, "u", "> yes\n\n> long line of many words here\nb"), (1, 5, "u", "yes"), (1, 6, "u", "x")]
    got = order(spark, rows)
    assert got[1, 3].reply_to == 1 and got[1, 4].reply_to == 0 and got[1, 4].quoted_turns == [0, 1]


def test_edges(spark):
    rows = [(1, 0, "u", None), (1, 0, "u", None), (1, 3, "u", ""), (1, 3, "t", "tie"), (None, 1, "u", "> a\nb"), (2, None, "u", "c"),
            (3, 5, None, "> quote only"), (3, -2, "u", "\n>\n> >  \nx")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = chat.reply_order(df).collect()
    assert sorted((repr(r.conv_id), repr(r.turn), r.text) for r in got) == sorted(
        [("1", "0", ""), ("1", "3", "tie"), ("None", "1", "b"), ("2", "None", "c"), ("3", "5", ""), ("3", "-2", "x")])
    by = {(r.conv_id, r.turn): r for r in got}
    assert by[1, 3].reply_to == 0 and by[3, 5].reply_to == -2 and by[3, 5].depth == 1
    assert by[None, 1].depth is None and by[2, None].branch is None
    assert chat.reply_order(df.limit(0)).count() == 0


def test_long_conversations_go_over_chunks(spark, monkeypatch):
    monkeypatch.setattr(chat, "CHUNK", 4)
    rows = [(1, t, "u", f"message number {t}") for t in range(0, 60, 2)]
    rows += [(1, 61, "u", "> message number 4\nbranch"), (1, 63, "u", "on"), (1, 65, "u", "> on\nmore"), (1, 67, "u", "> branch\nagain")]
    got = order(spark, rows)
    assert [got[1, t].depth for t in range(0, 60, 2)] == list(range(30))
    assert (got[1, 61].reply_to, got[1, 61].depth, got[1, 63].depth, got[1, 65].depth) == (4, 3, 4, 5)
    assert (got[1, 67].reply_to, got[1, 67].branch, got[1, 67].depth) == (61, 67, 4)


def test_depths_by_walking_up_on_random_replies(spark):
    import random

    rng = random.Random(1)
    rows, parent = [], {}
    for conv in range(6):
        for t in range(40):
            to = rng.randrange(t) if t and rng.random() < 0.4 else None
            rows.append((conv, t, "u", (f"> unique line {conv} {to}\n" if to is not None else "") + f"unique line {conv} {t}"))
            parent[conv, t] = to if to is not None else t - 1 if t else None
    got = order(spark, rows)
    for (conv, t), up in parent.items():
        depth, at = 0, t
        while parent[conv, at] is not None:
            at, depth = parent[conv, at], depth + 1
        assert (got[conv, t].reply_to, got[conv, t].depth) == (up, depth)


def test_no_python_in_the_plan(spark, folder):
    df = QUERIES["op3_chat_format"](spark, folder)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    rows = df.collect()
    assert len(rows) == spark.read.parquet(f"{folder}/conversations.parquet").count()
    assert all(r.depth == r.turn and r.branch == 0 for r in rows)
