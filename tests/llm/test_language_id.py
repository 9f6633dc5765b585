import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tillwork.llm import language_id
from tillwork.llm.queries import QUERIES

from .plain import clashing, frame

SCHEMA = "id long, text string, declared string, host string"


@pytest.fixture(scope="module")
def model(spark, folder):
    return language_id.fit(spark.read.parquet(f"{folder}/documents.parquet"))


def plain_trigrams(text):
    data = (text or "").encode().lower() if text and text.isascii() else bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    plain = b" " + bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in data) + b" "
    codes = [(plain[i - 1] << 16 | plain[i] << 8 | plain[i + 1]) for i in range(1, len(plain) - 1) if 97 <= plain[i] <= 122 or plain[i] >= 128]
    return [(c * 0x9E3779B97F4A7C15 % 2**64) >> (64 - language_id.CLASS_BITS) for c in codes]


def test_trigrams(odd_texts):
    code, text = language_id.trigrams(pa.array(odd_texts))
    for i, t in enumerate(odd_texts):
        assert code[text == i].tolist() == plain_trigrams(t)


def test_held_out_accuracy(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = language_id.fit(docs.filter("doc_id % 2 = 0"))
    held = docs.filter("doc_id % 2 = 1").select("text", "lang").collect()
    best = np.array(language_id.LANGUAGES + ("und",))[model.score(pa.array([r.text for r in held])).argmax(axis=1)]
    assert np.mean([b == r.lang for b, r in zip(best, held)]) > 0.97


def test_model_counts(spark):
    rows = [(i, t, g) for i, (t, g) in enumerate([("der die das", "de"), ("the cat", "en"), ("xx", "zz"), (None, "en"), ("le", None)])] + [(None, "el", "es")]
    got = language_id.fit(frame(spark, rows, "doc_id long, text string, lang string"))
    for k, text in enumerate(("der die das", "the cat", "", "")):
        counts = np.bincount(plain_trigrams(text), minlength=1 << language_id.CLASS_BITS) + 0.5
        assert np.allclose(got.table[k], np.log(counts / counts.sum()))
    assert np.allclose(got.table[-1], -math.log(1 << language_id.CLASS_BITS))
    assert np.allclose(language_id.fit(frame(spark, [], "doc_id long, text string, lang string")).table, got.table[-1])


def plain_identify(rows, model):
    """The fusion row by row."""
    names = [*model.languages, "und"]
    scores = model.score(pa.array([t for _, t, _, _ in rows], pa.string()))
    votes = [int(s.argmax()) if s.any() else None for s in scores]
    said = ["" if not d else d if d in model.languages else "other" for _, _, d, _ in rows]
    hosts = [h or "" for *_, h in rows]
    domain, suffix = [".".join(h.split(".")[-2:]) for h in hosts], [h.split(".")[-1] for h in hosts]
    tally = lambda keys: Counter((k, v) for k, v in zip(keys, votes) if v is not None)
    total, declared = Counter(v for v in votes if v is not None), tally(said)
    levels = [(suffix, tally(suffix)), (domain, tally(domain)), (hosts, tally(hosts))]
    k, n, out = len(names), sum(total.values()), []
    for r, row in enumerate(rows):
        prior = [(total[i] + 1) / (n + k) for i in range(k)]
        for keys, count in levels:
            own = [count[keys[r], i] - (votes[r] == i) for i in range(k)]
            prior = [(own[i] + language_id.WEIGHT * prior[i]) / (sum(own) + language_id.WEIGHT) for i in range(k)]
        logs = [language_id.TEMPER * scores[r][i] + math.log((declared[said[r], i] + 0.5) / (total[i] + 0.5 * (k + 1))) + math.log(prior[i])
                for i in range(k)]
        top = max(logs)
        share = 1 / sum(math.exp(x - top) for x in logs)
        lang = names[logs.index(top)] if votes[r] is not None else "und"
        out.append((row[0], lang, share if votes[r] is not None else 0.0, None if votes[r] is None else names[votes[r]], said[r],
                    lang != "und" and share >= 0.5))
    return out


def same(got, wanted):
    key = lambda r: (repr(r[0]), r[1], r[2])
    for a, b in zip(sorted(map(tuple, got), key=key), sorted(wanted, key=key), strict=True):
        assert a[:2] == b[:2] and a[2] == pytest.approx(b[2], abs=1e-9) and a[3:] == b[3:]


def test_fusion_equals_plain_version(spark, model, folder, odd_texts):
    texts = [r.text for r in spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").limit(80).collect()]
    hosts = ["a.example.de", "b.example.de", "example.fr", "localhost", "", None, "www.x.co.uk", "a.example.de"]
    rows = [(i, t[: 5 + 40 * (i % 4)], ("de", "en", None, "", "xx", "fr")[i % 6], hosts[i % 8]) for i, t in enumerate(texts)]
    rows += [(1000 + i, t, "en", "a.example.de") for i, t in enumerate(odd_texts)] + [(None, "nobody", "en", "q"), rows[0], rows[0]]
    got = language_id.identify(clashing(frame(spark, rows, SCHEMA), "vote", "v0", "lang"), model).collect()
    assert len(got) == len(rows)
    same(got, plain_identify(rows, model))
    assert language_id.identify(frame(spark, [], SCHEMA), model).count() == 0


def test_the_host_settles_a_short_text(spark, model):
    rows = [(i, "die der und ungen keit schen lich " * 5, "", "seite.example.de") for i in range(30)]
    rows += [(100 + i, "the thing with tion and ing " * 5, "", "site.example.com") for i in range(30)]
    rows += [(200, "in", "", "seite.example.de"), (201, "in", "", "site.example.com"), (202, "in", "", "other.example.de")]
    got = {r.id: r for r in language_id.identify(frame(spark, rows, SCHEMA), model).collect()}
    assert got[200].lang == "de" and got[201].lang == "en" and got[202].confidence < got[200].confidence


def test_unknown_text_is_rejected(spark, model):
    rows = [(1, "日本語の文章です。" * 20, "en", "a"), (2, "1234 !!", "en", "a"), (3, "привет как дела " * 10, "", "a"), (4, None, "en", "a")]
    got = {r.id: r for r in language_id.identify(frame(spark, rows, SCHEMA), model).collect()}
    assert all(got[i].lang == "und" and not got[i].accepted for i in (1, 2, 3, 4))


def test_address_markup_and_page_text(spark):
    pages = [("https://user:pw@WWW.Example.co.uk:80/fr/x?lang=de", '<HTML class=x LANG="en-GB"><style>p{}</style><p>Hi &amp; there</p><!-- no --><nav><a>menu</a></nav>'),
             ("ftp://h", "<html><body lang='de'>x"), (None, None), ("no address", "<html lang=fr>")]
    df = frame(spark, pages, "url string, html string")
    got = df.select(language_id.url_host("url"), language_id.markup_language("html"), language_id.page_text("html")).collect()
    plain = [(a, b, None if c is None else c.split()) for a, b, c in map(tuple, got)]
    assert plain == [("www.example.co.uk", "en", ["Hi", "there"]), ("h", "", ["x"]), (None, None, None), ("", "fr", [])]


def test_op9_keeps_labelled_documents_and_all_rows(spark, folder):
    rows = QUERIES["op9_language_id"](spark, folder).collect()
    docs = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    own = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert set(own) == set(docs) and len(rows) == len(docs) + spark.read.parquet(f"{folder}/pages.parquet").count()
    assert sum(own[i].accepted and own[i].lang == lang for i, lang in docs.items()) >= 0.99 * len(docs)
    assert all((r.doc_id is None) != (r.page_id is None) for r in rows)
