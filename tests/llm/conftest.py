import pytest

from tillwork.llm.registry import tuned


@pytest.fixture(autouse=True)
def settings(spark):
    tuned(spark)


@pytest.fixture
def odd_texts():
    """Null, empty, blank, short, repeated, very long, unusual characters."""
    return [None, "", " \t\n\r\x0b\x0c ", "A", "a b c d", "a b c d e", "The the THE", "x" * 20_000, "word " * 3_000,
            "é è ﬁ ① ² İΣΑΣ ς", "🙂 👩‍👩‍👧 日本語テキスト", "it's WE'LL <|endoftext|> ok", "a\u0085b c d", "\x1c\x1d\x1e\x1f",
            "A", "aaaa" * 60 + "ab" * 50]
