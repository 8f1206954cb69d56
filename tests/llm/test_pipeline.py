"""The pipeline against a brute-force version of its five stages, and awkward inputs."""

import re

import corpus_pipeline
import pyarrow as pa
from hourcast.llm import langid, packing
from test_dedup_tokens import brute_components, brute_fingerprint, brute_pack, model_greedy
from test_filters import brute_quality, brute_tiles, line_fails, words

SF = "/root/testdata/sf0.001"


def clean(text):
    return "\n".join(x for x in text.split("\n") if not (re.search(r"[^\x20\x09-\x0D]", x) and line_fails(x)))


def test_pipeline_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    net = langid.train(docs)
    lang, _ = langid._predict(pa.array([t for _, t in rows]), net, net.tables())
    rows = [(i, t) for (i, t), x in zip(rows, lang, strict=True) if x != "und"]
    rows = [(i, clean(t)) for i, t in rows if brute_quality(t)[-1]]
    fps = {i: brute_fingerprint(t) for i, t in rows}
    comp, least = brute_components(fps.values()), {}
    for i, f in fps.items():
        least[comp[f]] = min(least.get(comp[f], i), i)
    rows = [(i, t) for i, t in rows if least[comp[fps[i]]] == i]
    items = [words(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]

    def leaks(text):
        doc, grams = words(text), set()
        grams = {tuple(doc[k:k + 5]) for k in range(len(doc) - 4)}
        for item in items:  # a tile needs a shared run
            shared = [k for k in range(len(item) - 4) if tuple(item[k:k + 5]) in grams]
            reach = {k + j for k in shared for j in range(5)}
            if 2 * len(reach) >= len(item):
                near = [k for k in range(len(doc) - 4) if tuple(doc[k:k + 5]) in {tuple(item[s:s + 5]) for s in shared}]
                part = doc[max(0, near[0]):near[-1] + 5]
                if len(part) < 400 and 2 * sum(n for n, _, _ in brute_tiles(item, part, 5)) >= len(item):
                    return True
        return False
    before = len(rows)
    rows = [(i, t) for i, t in rows if not leaks(t)]
    assert len(rows) < before
    count = model_greedy()
    lengths = {i: sum(count(w) for w in re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t in rows}
    got = corpus_pipeline.run(spark, SF).collect()
    pieces = {}
    for r in got:
        pieces.setdefault(r.doc_id, []).append(r.n_tokens)
    assert {i: sum(n) for i, n in pieces.items()} == lengths
    bins = {}
    for r in got:
        bins.setdefault((r.bin_id, r.capacity), []).append(r.n_tokens)
    assert sorted((c, sum(n)) for (_, c), n in bins.items()) == brute_pack([r.n_tokens for r in got], packing.CAPACITIES)


def test_stages_on_awkward_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, fp long, id long"
    prose = "The quick brown fox jumps over the lazy dog and then it runs far away into the deep green forest to sleep. It was tired."
    rows = [(1, None, "en", "s", 0, True, 1, 1), (2, "", None, None, None, None, None, None), (3, prose, "en", "s", 1, False, 1, 2),
            (3, prose, "en", "s", 1, False, 1, 2), (None, prose + " And so on it goes, for ever and ever after.", None, None, None, None, None, None),
            (4, "12 34", "en", "s", 5, True, 1, 1)]
    df = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, df, SF)
        empty = stage(spark, df.limit(0), SF)
        assert empty.count() == 0, name
        if name != "best_fit_packing":
            assert out.columns[:5] == corpus_pipeline.COLUMNS and empty.columns[:5] == corpus_pipeline.COLUMNS
        assert {r.doc_id for r in out.collect()} >= {3}, name


def test_null_language_is_filled(spark):
    rows = [(i, text, lang, "s", 1) for i, (text, lang) in enumerate([("balka mo balmo " * 9, "aa"), ("schei ü eisch " * 9, "bb")] * 40)]
    rows += [(100, "balka mo balmo " * 5, None, "s", 1), (101, "schei ü eisch " * 5, None, "s", 1), (102, "12 34", None, "s", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r.lang for r in corpus_pipeline.language(spark, df, SF).collect()}
    assert got == {**{i: lang for i, _, lang, _, _ in rows[:80]}, 100: "aa", 101: "bb"}


def test_run_leaves_only_its_result(spark):
    import os

    from hourcast.session import scratch_dir
    there = lambda: set(os.listdir(os.path.dirname(scratch_dir(spark)).removeprefix("file:")))
    before = there()
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and there() - before == {os.path.basename(out.scratch_path)}
