import random
import re

import pyarrow as pa

from tillwork.llm import signals

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    """Words, different words, words in repeated windows of three, lines with words, different ones."""
    w = WORD.findall(text)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often = {x for x in windows if windows.count(x) > 1}
    inside = {i + k for i, x in enumerate(windows) if x in often for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), len(set(w)), len(inside), len(lines), len(set(lines))


def test_counts_equal_plain_ones(odd_texts):
    rng = random.Random(3)
    texts = [t for t in odd_texts if t is not None and len(t) < 5000]
    texts += ["".join(rng.choice(["a", "b", "C", "é", " ", " ", "\n", "\t", "\r", "\x1c", "\x85", "#"]) for _ in range(rng.randrange(200))) for _ in range(200)]
    column = pa.array(texts)
    words, lines = signals.words(column), signals.lines(column)
    got = zip(words.count, words.different(), words.repeated(), lines.count, lines.different())
    assert [tuple(map(int, g)) for g in got] == [plain_counts(t) for t in texts]
    chars, upper, symbols = signals.totals(column, signals.LEADS & ~signals.BLANK, signals.UPPER, signals.byte_class("#"))
    assert chars.tolist() == [sum(map(len, WORD.findall(t))) for t in texts]
    assert upper.tolist() == [len(re.findall("[A-Z]", t)) for t in texts] and symbols.tolist() == [t.count("#") for t in texts]


def test_windows_do_not_cross_texts_and_empty_columns_work():
    column = pa.array(["a b", "c a b", "c", "a b c a b c"])
    assert signals.words(column).repeated().tolist() == [0, 0, 0, 6]
    none = pa.array([], pa.string())
    assert signals.words(none).count.tolist() == [] and signals.words(none).repeated().tolist() == [] and signals.lines(none).different().tolist() == []
    assert signals.words(pa.array(["", " "])).different().tolist() == [0, 0]


def test_a_very_long_text_of_many_words():
    text = " ".join(f"w{i}" for i in range(300_000)) + " w1 w2 w3"
    words = signals.words(pa.array([text]))
    assert (words.count[0], words.different()[0], words.repeated()[0]) == (300_003, 300_000, 6)


def test_struct_of_slices_keeps_the_order_of_rows():
    column = pa.chunked_array([["a b", None], ["x " * 900_000, "c"], []])
    got = signals.struct_of(column, lambda t: {"n": signals.words(t).count})
    assert got.field("n").to_pylist() == [2, 0, 900_000, 1]
