
import corpus_pipeline
from tillwork.llm import language_id
from tillwork.llm.queries import QUERIES

from .plain import clashing, frame, spaced
from .test_contamination import plain_hits, windows
from .test_language_id import plain_identify
from .test_near_duplicates import plain_components, plain_repeats
from .test_tokens import library

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def plain_pipeline(rows, items, model):
    """The stages row by row: (doc_id, text, lang, source) to the same and the ids."""
    accepted = {r[0] for r in plain_identify([(i, t, g and g.lower(), s) for i, t, g, s in rows], model) if r[5]}
    rows = [r for r in rows if r[0] is None or r[0] in accepted]
    gone, left = plain_repeats([(i, t) for i, t, *_ in rows]), []
    for i, t, g, s in rows:
        own = {k for d, k in gone if d == i}
        if own:
            t = "\n".join(x for k, x in enumerate(t.split("\n")) if k not in own)
            if not spaced(t):
                continue
        left.append((i, t, g, s))
    comp, _ = plain_components([(i, t) for i, t, *_ in left], 80)
    left = [r for r in left if r[0] is None or comp[r[0]] == r[0]]
    found = windows(items)
    left = [r for r in left if not plain_hits(r[1], found)[1]]
    return [(i, t, g, s, library().encode_ordinary(t or "")) for i, t, g, s in left]


def check(got, wanted):
    import numpy as np

    key = lambda r: (repr(r[0]), repr(r[1]))
    rows = [(r.doc_id, r.text, r.lang, r.source, np.frombuffer(r["ids"], "<u4").tolist()) for r in got]
    assert sorted(rows, key=key) == sorted(wanted, key=key)
    assert all(r.round_trip and r.n_tokens == len(r["ids"]) // 4 and (r.text is None or r.n_chars == len(r.text)) for r in got)


def benchmark(spark, folder):
    return [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]


def test_run_equals_the_plain_pipeline_on_whole_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()]
    got = QUERIES["pipeline"](spark, folder).collect()
    wanted = plain_pipeline(rows, benchmark(spark, folder), language_id.fit(docs))
    check(got, wanted)
    assert 0 < len(got) < len(rows)


def test_stages_on_odd_rows(spark, folder, odd_texts, tmp_path):
    some = spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").limit(60).collect()
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in some]
    rows += [(10_000 + i, t, "en", None, len(t or "")) for i, t in enumerate(odd_texts)]
    rows += [(None, "the thing with the tion and ing", None, "x", None), (20_000, some[0].text, some[0].lang, "y", 1), (20_001, "日本語" * 30, None, "x", 90)]
    df = clashing(frame(spark, rows, SCHEMA), "ids", "lines", "found", "gone", "_gone", "doc", "host")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    model = language_id.fit(docs)
    for at, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / name)
        out = stage(spark, docs, folder)
        assert at == 4 or out.columns == df.columns, name
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    wanted = plain_pipeline([(r[0], r[1], r[2], r[3]) for r in rows], benchmark(spark, folder), model)
    got = docs.collect()
    assert 20_001 not in {r.doc_id for r in got} and None in {r.doc_id for r in got}
    check([r for r in got if r.doc_id is not None], [w for w in wanted if w[0] is not None])


def test_stages_on_an_empty_table(spark, folder):
    docs = frame(spark, [], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0


def test_stage_list():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_duplicates", "decontaminate", "tokenize"]
    assert corpus_pipeline.ORACLE_SQL is None and "pipeline" in QUERIES

