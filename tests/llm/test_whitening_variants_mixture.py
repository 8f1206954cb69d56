"""Whitening, spelling variants, mixture packing: brute force, library decompositions, edge cases."""

import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import duckdb
import numpy as np
import pytest

from hourcast.llm import mixture, queries, token_store, variants, whitening

SF = "/root/testdata/sf0.001"


# ---- whitening --------------------------------------------------------------------

def test_eigenvectors_against_numpy():
    r = np.random.default_rng(3)
    cases = []
    for n in (1, 2, 3, 5, 17, 64):
        q, _ = np.linalg.qr(r.normal(size=(n, n)))
        cases += [q @ np.diag(v) @ q.T for v in (
            r.uniform(0, 9, n), np.ones(n), np.repeat([5.0, 1.0], [n // 2, n - n // 2]), 10.0 ** -np.arange(n),
            np.append(np.full(n - 1, 2.0), 2.0 + 1e-9))]
        cases.append(np.diag(r.uniform(0, 1, n)))
    for a in cases:
        a = (a + a.T) / 2
        values, vectors = whitening.leading_components(a, 4)
        want = np.linalg.eigvalsh(a)[::-1][:4]
        size = max(want[0], 1e-300)
        want = want[want > 1e-14 * np.trace(a)]
        assert len(values) >= min(len(want), 1) and np.allclose(values, want[:len(values)], atol=1e-13 * size, rtol=0)
        assert np.abs(vectors @ vectors.T - np.eye(len(values))).max() < 1e-12
        assert np.abs(a @ vectors.T - vectors.T * values).max() < 1e-12 * size


def brute_whitening(rows):
    """{(id, component): (n, deviation, |whitened|, explained)} from numpy's own decomposition."""
    x = {}
    for i, vec in rows:
        if vec is not None and all(c is not None and np.isfinite(c) for c in vec):
            x[i] = [int(np.floor(256 * float(c))) for c in vec]
    fit = sorted({tuple(v) for v in x.values()})
    n, total = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    c = np.array(fit) - np.array(total) / n
    values, vectors = np.linalg.eigh(c.T @ c / n)
    out = {}
    for i, v in x.items():
        for k in range(1, 5):
            w = (np.array(v) - np.array(total) / n) @ vectors[:, -k] / np.sqrt(values[-k])
            out[i, k] = (n, sum((n * a - s) ** 2 for a, s in zip(v, total, strict=True)), abs(w), values[-k] / values.sum())
    return out


def test_whitening_query_against_numpy(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want = brute_whitening(rows)
    got = queries.op11_embedding_whitening(spark, SF).collect()
    assert len(got) == len(want)
    signs = {}
    for r in got:
        n, deviation, size, explained = want[r.vec_id, r.component]
        assert (r.n, r.deviation) == (n, deviation)
        assert abs(abs(r.whitened) - size) < 1e-6 and abs(r.explained - explained) < 1e-10 and r.identity_error < 1e-9
        signs[r.vec_id, r.component] = r.whitened
    ids = sorted({i for i, _ in signs})
    w = {k: np.array([signs[i, k] for i in ids]) for k in range(1, 5)}
    assert abs(np.corrcoef(w[1], w[2])[0, 1]) < 0.2


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def test_whitening_edges(spark):
    r = random.Random(1)
    good = [(i, [r.uniform(-1, 1) for _ in range(6)]) for i in range(40)]
    bad = [(100, None), (101, [None] * 6), (102, [float("nan")] * 6), (103, [float("inf")] + [0.0] * 5), (104, []), (105, [1.0]), (106, [3e38] * 6)]
    same = [(None, good[0][1]), (7, good[7][1]), (7, good[7][1])] + [(200 + i, good[3][1]) for i in range(50)]
    got = whitening.whiten(vectors(spark, good + bad + same)).collect()
    want = brute_whitening([(i, [float(np.float32(c)) for c in v]) for i, v in good])
    assert Counter(x.id for x in got) == Counter({**{i: 4 for i in range(40)}, 7: 12, None: 4, **{200 + i: 4 for i in range(50)}})
    for x in got:
        i = {None: 0}.get(x.id, 3 if x.id is not None and x.id >= 200 else x.id)
        n, deviation, size, explained = want[i, x.component]
        assert (x.n, x.deviation) == (n, deviation) and abs(abs(x.whitened) - size) < 1e-8 and abs(x.explained - explained) < 1e-12
    assert whitening.whiten(vectors(spark, [])).count() == 0
    assert whitening.whiten(vectors(spark, bad)).count() == 0  # one vector of one entry: no variance
    assert whitening.whiten(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    two = whitening.whiten(vectors(spark, [(1, [1.0, 2.0]), (2, [2.0, 4.0])])).collect()
    assert sorted((x.id, x.component, abs(round(x.whitened, 9)), x.explained) for x in two) == [(1, 1, 1.0, 1.0), (2, 1, 1.0, 1.0)]
    assert {x.deviation for x in two} == {256 ** 2 + 512 ** 2}
    clash = spark.createDataFrame([(1, [0.0], 5, 6), (2, [1.0], 5, 6)], "vec_id long, embedding array<double>, id long, component int")
    assert [(x.id, x.n) for x in whitening.whiten(clash).orderBy("id").collect()] == [(1, 2), (2, 2)]
    huge = whitening.whiten(vectors(spark, [(1, [1e13, 0.0]), (2, [-1e13, 0.0])])).collect()
    assert [x.deviation for x in huge] == [None, None] and {round(abs(x.whitened), 9) for x in huge} == {1.0}


def test_sums_over_many_tasks(spark):
    df = spark.range(1000).selectExpr("array(id, -id, id * id) as x").repartition(70)
    n, total = whitening.sums(df, 3)
    assert n == 1000 and total == [499500, -499500, sum(i * i for i in range(1000))]


# ---- spelling variants --------------------------------------------------------------

def brute_words(rows):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}


def brute_near(words):
    """Words that become equal when one letter of either is blanked or taken out."""
    keys = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            keys["r", w[:i], w[i + 1:]].add(w)
            keys["d", w[:i] + w[i + 1:]].add(w)
    near = {w: set() for w in words}
    for w in words:
        for i in range(len(w)):
            near[w] |= keys["r", w[:i], w[i + 1:]]
        near[w] |= keys.get(("d", w), set())
        near[w] |= {w[:i] + w[i + 1:] for i in range(len(w))} & near.keys()
        near[w].discard(w)
    return near


def brute_forms(n, ratio=10):
    near, form = brute_near(n), {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def found(df):
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def test_variants_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = queries.op12_spelling_variants(spark, SF)
    want = brute_forms(brute_words(rows))
    assert got.count() == len(want) and found(got) == want
    assert any(f for _, f, *_ in want) and max(k for *_, k, _ in want) > 5


def test_index_against_brute_force():
    r = random.Random(5)
    for _ in range(60):
        words = sorted({"".join(r.choices("abc", k=r.randint(1, 7))) for _ in range(r.randint(1, 60))})
        index, near = variants.Index(words), brute_near(words)
        for w in [*words, "abcabcabcabc", "c"]:
            if w not in near:
                near = brute_near([*words, w])
            for skip in (1 << 31, 1, 2, len(w)):
                sets = index.near(w, skip)
                got = {words[i] for s in sets for i in variants.bits(s)}
                assert got == {v for v in near[w] if v[:skip] != w[:skip]}, (w, words, skip)
                assert all(len(words[i]) == len(w) + k for s, k in zip(sets, (0, -1, 1), strict=True) for i in variants.bits(s))


@pytest.mark.parametrize("cell", [2, 7, 1024])
def test_cells_lose_no_pair(spark, cell):
    r = random.Random(6)
    words = {"prefix" + "".join(r.choices("abc", k=r.randint(1, 6))) for _ in range(150)}
    words |= {"".join(r.choices("ab", k=r.randint(7, 9))) for _ in range(150)} | {"".join(r.choices("ab", k=4)) + "ingénue" for _ in range(30)}
    n = {w: r.choice([2, 3, 30, 400, 5000, 70000]) for w in words}
    df = spark.createDataFrame(list(n.items()), "word string, n long")
    assert found(variants.forms(df, cell=cell)) == brute_forms(n)


def test_variants_edges(spark):
    schema = "doc_id long, text string, word string, n long"
    rows = [(1, None), (2, ""), (None, "mountain mountain"), (3, "MOUNTAIN Mountain, mountaîn! ÀÉÎÕÜÝß ÀÉÎÕÜÝß"), (3, "mountain"), (4, "a" * 100_000 + " " + "a" * 100_000)]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], schema)
    assert found(variants.forms(variants.word_counts(df))) == brute_forms(brute_words(rows))
    assert variants.forms(variants.word_counts(df.limit(0))).count() == 0
    ties = spark.createDataFrame([("abcdefg", 2), ("abcdefh", 20), ("abcdefgh", 20), ("bbcdefg", 20)], "word string, n long")
    assert {(w, f) for w, f, *_ in found(variants.forms(ties))} == {("abcdefg", "abcdefgh"), ("abcdefh", None), ("abcdefgh", None), ("bbcdefg", None)}
    chain = spark.createDataFrame([("aaaaaaa", 2), ("aaaaaab", 20), ("aaaaabb", 200), ("aaaabbb", 2000), ("aaabbbb", 20000)], "word string, n long")
    assert {r for _, _, r, *_ in found(variants.forms(chain))} == {"aaabbbb"}
    clash = spark.createDataFrame([(1, "mountain mountain", "w", 3)], schema)
    assert [r.n for r in variants.word_counts(clash).collect()] == [2]


def test_variants_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    sql = con.execute(f"SELECT word, form, root, n, n_near, form_n FROM ({queries.ORACLE_SQL['op12_spelling_variants']})").fetchall()
    assert set(sql) == found(queries.op12_spelling_variants(spark, SF))


# ---- mixture packing ------------------------------------------------------------------

def brute_rounds(weight, total, capacity, grain):
    """The queues, grain by grain: a list of (queue, token of the queue)."""
    deficit, at, out = [Fraction(0)] * len(weight), [0] * len(weight), []
    while any(a < t for a, t in zip(at, total, strict=True)):
        for q, w in enumerate(weight):
            deficit[q] += Fraction(capacity * int(w), int(sum(weight)))
            while deficit[q] >= grain:
                deficit[q] -= grain
                take = min(grain, total[q] - at[q])
                out += [(q, at[q] + k) for k in range(take)]
                at[q] += take
    return out


def test_rounds_against_deficit_round_robin():
    r = random.Random(7)
    for _ in range(40):
        queues, capacity, grain = r.randint(1, 5), r.choice([8, 16, 64]), r.choice([1, 3, 4, 8])
        weight, total = [r.randint(1, 20) for _ in range(queues)], [r.choice([0, 1, r.randint(1, 400)]) for _ in range(queues)]
        want = brute_rounds(weight, total, capacity, grain)
        rounds = mixture.Rounds(np.array(weight), np.array(total), capacity, grain)
        docs = []
        for q, t in enumerate(total):
            at = 0
            while at < t:
                n = min(r.randint(1, 90), t - at)
                docs.append((q, at, n))
                at += n
        if not docs:
            continue
        r.shuffle(docs)
        queue, start, n = map(np.array, zip(*docs, strict=True))
        doc, first, size, place = mixture.place_documents(rounds, queue, start, n)
        got = {}
        for d, f, k, p in zip(doc, first, size, place, strict=True):
            for j in range(k):
                got[int(p) + j] = (int(queue[d]), int(start[d] + f) + j)
        assert [got[i] for i in range(len(want))] == want and len(got) == len(want)
        d2, f2, k2, seq, off = mixture.cut_at_windows(doc, first, size, place, len(want), capacity)
        lengths = Counter()
        for s, k in zip(seq.tolist(), k2.tolist(), strict=True):
            lengths[s] += k
        full = len(want) // capacity
        assert [lengths[s] for s in range(full)] == [capacity] * full
        tail = [lengths[s] for s in sorted(lengths) if s >= full]
        assert tail == sorted(tail, reverse=True) and all(x & (x - 1) == 0 for x in tail) and sorted(lengths) == list(range(len(lengths)))
        base = {s: sum(lengths[t] for t in range(s)) for s in lengths}
        again = {base[s] + o + j: (int(queue[d]), int(start[d] + f) + j)
                 for d, f, k, s, o in zip(d2.tolist(), f2.tolist(), k2.tolist(), seq.tolist(), off.tolist(), strict=True) for j in range(k)}
        assert again == got


def test_rounds_of_huge_queues():
    """The closed form against exact integers, far beyond 64-bit products."""
    weight, total = np.array([1, 700_000, 348_575]), np.array([1 << 43, 1 << 42, 12_345])
    rounds = mixture.Rounds(weight, total)
    r = np.array([1, 10 ** 6, 10 ** 12, 1 << 51])
    want = [[min(int(t), 64 * (int(x) * 2048 * int(w) // (64 * int(weight.sum())))) for w, t in zip(weight, total, strict=True)] for x in r]
    assert rounds.served(r).tolist() == want
    g = np.array([0, 5, (1 << 37) - 1])
    assert rounds.round_of(np.zeros(3, dtype=int), g).tolist() == [-(-(int(x) + 1) * 64 * int(weight.sum()) // 2048) for x in g]


def check_pieces(rows, texts, tokenizer=None):
    """rows: (id, start, length, crc, doc_tokens, sequence, offset); texts: {id: text}, ids unique."""
    encode = token_store.encoder(tokenizer or token_store.default_tokenizer())
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for i, start, n, crc, total, seq, off in rows:
        by_doc[i].append((start, n, crc, total))
        by_seq[seq].append((off, n))
    assert by_doc.keys() == texts.keys()
    for i, pieces in by_doc.items():
        ids = np.array([*encode.tokenizer.encode(texts[i] or "", add_special_tokens=False).ids, 1], dtype="<u4")
        at = 0
        for start, n, crc, total in sorted(pieces):
            assert start == at and n > 0 and total == len(ids) and crc == zlib.crc32(ids[at:at + n].tobytes())
            at += n
        assert at == len(ids)
    assert sorted(by_seq) == list(range(len(by_seq)))
    for seq, pieces in by_seq.items():
        at = 0
        for off, n in sorted(pieces):
            assert off == at
            at += n
        assert at <= 2048 and at & (at - 1) == 0


def test_mixture_query(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = [tuple(r) for r in queries.op13_mixture_packing(spark, SF).collect()]
    check_pieces(rows, {i: d.text for i, d in docs.items()})
    total, window = Counter(), defaultdict(Counter)
    for i, _, n, _, _, seq, _ in rows:
        total[docs[i].source] += n
        window[seq][docs[i].source] += n
    whole, full = sum(total.values()), sum(total.values()) // 2048
    for seq in range(full - 1):  # a grain to carry, one round's shift at the window's ends
        for s, n in total.items():
            assert abs(window[seq][s] - 2048 * n / whole) <= 3 * mixture.GRAIN, (seq, s)


def test_mixture_edges(spark):
    schema = "doc_id long, text string, source string, start long, queue string"
    texts = {1: None, 2: "", 3: "one two three", 4: "word " * 30_000, 5: "x", None: "no id", 7: "seven " * 500, 8: "eight " * 900}
    sources = {1: "a", 2: None, 3: "b", 4: "a", 5: "", None: "b", 7: None, 8: "c"}
    df = spark.createDataFrame([(i, t, sources[i], 9, "q") for i, t in texts.items()], schema).repartition(3, "doc_id")
    for weights in (None, {"a": 1, None: 1.0, "c": 2}, {"nowhere": 1}, {"a": 1, "b": 1e-9}):
        got = mixture.pack(df, weights=weights).collect()
        check_pieces([(r.id, r.start, r.length, zlib.crc32(r.ids), r.doc_tokens, r.sequence_id, r.offset) for r in got], texts)
        assert {(r.id, r.source) for r in got} == set(sources.items())
    assert mixture.pack(df.limit(0)).count() == 0
    twice = spark.createDataFrame([(1, "one two", "s")] * 3, "doc_id long, text string, source string")
    assert [(r.sequence_id, r.offset, r.length) for r in mixture.pack(twice).orderBy("sequence_id", "offset").collect()] == [(0, 0, 3), (0, 3, 3), (0, 6, 2), (1, 0, 1)]


def test_mixture_by_weights(spark):
    rows = [(i, "word " * 999, "ab"[i % 2]) for i in range(60)] + [(100 + i, "rare " * 10, f"s{i}") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    window = defaultdict(Counter)
    for r in mixture.pack(df, weights={"a": 3, "b": 1}).collect():
        window[r.sequence_id][r.source if r.source in "ab" else "rest"] += r.length
    tokens = {"a": 30_000, "b": 30_000, "rest": 3300}
    rest = 2048 * 3300 / 63_300
    for seq in range(15):  # until source a runs dry
        share = (2048 - window[seq]["rest"])
        assert abs(window[seq]["a"] - 0.75 * share) < 130 and abs(window[seq]["rest"] - rest) < 130, window[seq]
    assert Counter({k: sum(w[k] for w in window.values()) for k in tokens}) == tokens
