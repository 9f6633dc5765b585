import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tillwork.llm.words import ALNUM, SPACED, grams, slices, words_of

from .plain import alnum, spaced


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(st.sampled_from("aAbZ09 .\n\té日🙂"), max_size=30), max_size=6))
def test_words_are_those_of_the_pattern(texts):
    for alphabet, plain in ((SPACED, spaced), (ALNUM, alnum)):
        found = words_of(pa.array(texts, pa.string()), alphabet)
        wanted = [plain(t) for t in texts]
        assert found.counts.tolist() == [len(w) for w in wanted]
        numbers = {}
        for word, number in zip((w for t in wanted for w in t), found.hash.tolist()):
            assert numbers.setdefault(word, number) == number
        assert len(set(numbers.values())) == len(numbers)


def test_nulls_offsets_and_long_words():
    texts = pa.array(["skipped", None, "ab  cd", "", "z" * 700_000 + " ab"])[1:]
    found = words_of(texts)
    assert found.counts.tolist() == [0, 2, 0, 2]
    assert found.hash[0] == found.hash[3]


def test_runs_depend_on_order_and_only_on_the_words():
    a, b = words_of(pa.array(["p q r s"])).hash, words_of(pa.array(["x p q r", "s r q p"])).hash
    assert grams(a, 3)[0] == grams(b, 3)[1]
    assert not np.isin(grams(b, 3)[4:], grams(a, 3)).any()
    assert len(grams(a, 5)) == 0


def test_slices_cover_all_texts():
    texts = pa.array(["ab" * n for n in range(50)])
    parts = list(slices(texts, 300))
    assert pa.concat_arrays([p for _, p in parts]).equals(texts) and len(parts) > 5
    assert [at for at, _ in parts][0] == 0 and list(slices(pa.array([], pa.string()))) == []


def test_built_words_have_their_own_numbers():
    # a word and its complement after Thue and Morse agree under any power sum modulo 2**64
    signs = [i.bit_count() % 2 for i in range(1024)]
    built = ["".join("ab"[s] for s in signs), "".join("ba"[s] for s in signs)]
    built += ["".join("ab"[s] for s in signs[:64]), "".join("ba"[s] for s in signs[:64])]
    numbered = [f"w{i}" for i in range(1_500_000)]
    found = words_of(pa.array([" ".join(built), " ".join(numbered)]))
    assert len(np.unique(found.hash)) == len(built) + len(numbered)


def test_all_sizes_of_words_and_all_ends():
    rows = ["a" * n for n in range(1, 140)] + ["a" * n + "b" for n in range(1, 140)] + ["\0" * n for n in range(1, 140)]
    found = words_of(pa.array([" ".join(rows)]))
    assert len(set(found.hash.tolist())) == len(rows)
    assert words_of(pa.array(rows)).hash.tolist() == found.hash.tolist()
