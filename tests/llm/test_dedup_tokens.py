"""SimHash, token files, token counts, packing: brute force, round trips, edge cases."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from hourcast.llm import common, packing, queries, simhash, token_count, token_store
from hourcast.llm.common import connected_components, ranked

SF = "/root/testdata/sf0.001"


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


# ---- simhash --------------------------------------------------------------------

def brute_fingerprint(text, k=4):
    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def brute_components(fps, radius=4):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    fs = sorted(root)
    for i, a in enumerate(fs):
        for b in fs[i + 1:]:
            if (a ^ b).bit_count() <= radius:
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {f: find(f) for f in fs}


def check_classes(rows, texts):
    fps = [brute_fingerprint(t) for _, t in texts]
    comp = brute_components(fps)
    least = {}
    for (i, _), f in zip(texts, fps, strict=True):
        if i is not None:
            least[comp[f]] = min(least.get(comp[f], i), i)
    want = sorted(((i, f, least.get(comp[f])) for (i, _), f in zip(texts, fps, strict=True)), key=str)
    assert sorted(((r.id, r.fp % (1 << 64), r.component) for r in rows), key=str) == want


def test_query_against_brute_force(spark):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = queries.op4_simhash_near_dedup(spark, SF).collect()
    assert len(rows) == len(texts)
    fps = {i: brute_fingerprint(t) for i, t in texts}
    comp = brute_components(fps.values())
    least = {}
    for i, f in fps.items():
        least[comp[f]] = min(least.get(comp[f], i), i)
    for r in rows:
        assert r.fingerprint == f"{fps[r.doc_id]:016x}" and r.component_id == least[comp[fps[r.doc_id]]]


def test_simhash_edges(spark):
    texts = [(5, None), (3, ""), (9, " \n\t"), (None, "a b"), (None, "only null id here now"), (1, "A b"), (2, "A B c d e f g h"), (2, "A B c d e f g h"),
             (4, "x " * 50_000), (6, "é É ß Straße")]
    check_classes(simhash.near_duplicates(docs(spark, texts)).collect(), texts)
    assert simhash.near_duplicates(docs(spark, [])).count() == 0
    clash = spark.createDataFrame([(1, "a b c d", 7, 8, "x"), (2, "a b c d", 7, 8, "y")], "doc_id long, text string, fp long, component long, id string")
    assert [(r.id, r.component) for r in simhash.near_duplicates(clash).orderBy("id").collect()] == [(1, 1), (2, 1)]
    kept = simhash.keep_one(clash).collect()
    assert [r.doc_id for r in kept] == [1] and kept[0].asDict()["id"] == "x"
    texts += [(None, "another null id and quite another text"), (None, "another null id and quite another text"), (2, "id two once more, but a text of its own")]
    left = sorted(((r.doc_id, r.text) for r in simhash.keep_one(docs(spark, texts)).collect()), key=str)
    assert left == sorted([texts[1], texts[4], texts[5], texts[6], texts[8], texts[9], texts[10], texts[12]], key=str)


def test_links_in_hot_cells(spark):
    """Fingerprints that share most blocks: cells beyond the tile size, cut by bit count and salt."""
    r = random.Random(2)
    base = r.getrandbits(64)
    fps = {base}
    for _ in range(300):
        f = base
        for b in r.sample(range(20), r.randrange(1, 9)):
            f ^= 1 << b
        fps.add(f)
    fps |= {r.getrandbits(64) for _ in range(100)}
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    df = spark.createDataFrame(signed, "fp long")
    want = brute_components(fps)
    for rows in (1024, 20):
        got = {n.node % (1 << 64): n.root for n in connected_components(simhash.links(df, tile_rows=rows)).collect()}
        classes = {}
        for f in fps:
            classes.setdefault(got.get(f, f"alone{f}"), set()).add(f)
        brute = {}
        for f, c in want.items():
            brute.setdefault(c, set()).add(f)
        assert sorted(map(sorted, classes.values())) == sorted(map(sorted, brute.values()))


def test_every_link_shares_a_mask():
    r = random.Random(4)
    for n in (10, 10**8, 10**11):
        masks = simhash._schemes(4, n)
        for _ in range(200):
            a = r.getrandbits(64)
            b = a
            for bit in r.sample(range(64), 4):
                b ^= 1 << bit
            assert any(a & (m % (1 << 64)) == b & (m % (1 << 64)) for m in masks)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_of_hot_keys(spark, monkeypatch, how):
    """Hot, null, missing and rare keys give the plain join's rows."""
    many = [(1, k) for k in range(60)] + [(None, k) for k in range(40)] + [(2, k) for k in range(30)] + [(k, k) for k in range(3, 50)] + [(3, 3)] * 2
    d = spark.createDataFrame(many, "key long, a long")
    one = spark.createDataFrame([(k, f"v{k}") for k in [1, 3, 4, 5, 90, *range(20, 40)]] + [(None, "null")], "key long, b string")
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    want = rows(d.join(one, "key", how))
    assert rows(common.join_one(d, one, "key", how)) == want
    for hot, keys in ((10, 4096), (10, 4), (45, 4096), (10 ** 6, 4)):
        monkeypatch.setattr(common, "HOT_ROWS", hot)
        monkeypatch.setattr(common, "HOT_KEYS", keys)
        assert rows(common.join_one(d, one, "key", how)) == want == rows(common.join_one(d, one, "key", how, rows=len(many)))
    assert common.join_one(d.limit(0), one, "key", how).count() == 0


def test_components_with_hubs(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_ROWS", 5)
    r = random.Random(4)
    edges = [(0, k) for k in range(1, 40)] + [(k, 500) for k in range(100, 140)] + [(r.randrange(600, 700), r.randrange(600, 700)) for _ in range(60)] + [(39, 39), (139, 610)]
    parent = {n: n for e in edges for n in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    got = {x.node: x.root for x in common.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: find(n) for a, b in edges if a != b for n in (a, b)}


def test_keep_one_shuffles_texts_once(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    out = simhash.keep_one(d)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = out.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    text = d.columns.index("text")
    wide = [x for x in plan.split("\n") if "Exchange hashpartitioning" in x and "_none" in x and "_key" in x]
    assert text >= 0 and len(wide) == 2, plan  # one of the documents, one of the kept ids


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(1000, 999), (5, 5)], "a long, b long")
    got = {r.node: r.root for r in connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(201)}, 999: 999, 1000: 999}


# ---- token files ------------------------------------------------------------------

def test_token_query_against_the_tokenizer(spark):
    texts = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    tok = token_store.Encoder(token_store.default_tokenizer()).tokenizer
    start = 0
    got = {r.doc_id: r for r in queries.op5_token_binary(spark, SF).collect()}
    assert len(got) == len(texts)
    for i, t in texts:
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4")
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_words_one_by_one_are_the_whole_text():
    e = token_store.Encoder(token_store.default_tokenizer())
    r = random.Random(6)
    letters = ["a", "B", "é", "é", "́", "Σ", "'s", "'", "1", "²", "<|endoftext|>", "<|startoftext|>", "!", " ", " ", "中", "\x01", " ", "\n", "\x0b", "\x1c"]
    texts = ["".join(r.choices(letters, k=r.randint(0, 40))) for _ in range(300)] + [None, ""]
    ids, sizes = e(pa.array(texts, pa.string()))
    end = np.cumsum(sizes)
    for t, i, j in zip(texts, end - sizes, end, strict=True):
        assert ids[i:j].tolist() == [*e.tokenizer.encode(t or "", add_special_tokens=False).ids, 1], t


def test_shard_round_trip_and_random_access():
    r = random.Random(7)
    for n, k in ((0, 1), (1, 1), (50, 1), (5000, 3), (5000, 400), (70_000, 66_000)):
        ids = np.array([r.randrange(k) * 7 for _ in range(n)], dtype=np.uint32)
        s = token_store.Shard.unpack(token_store.Shard.build(ids, np.array([4]), np.array([False]), np.array([n])).pack())
        assert (s.decode() == ids).all() and len(s.decode()) == n
        for _ in range(30):
            a = r.randrange(n + 1)
            b = r.randrange(a, n + 3)
            assert s.decode(a, b).tolist() == ids[a:b].tolist()
    assert len(token_store.re_pair(np.array([1, 2] * 5000))[3]) < 100


def test_token_file_edges(spark, tmp_path):
    rows = [(3, "c c"), (None, "n"), (1, None), (2, ""), (3, "c c"), (9, "word " * 9000)]
    path = str(tmp_path / "shards")
    token_store.write_tokens(docs(spark, rows), path, shard_tokens=100)
    got = token_store.read_tokens(spark, path).orderBy("start").collect()
    assert [r.id for r in got] == [None, 1, 2, 3, 3, 9]
    assert [r.n_tokens for r in got] == [2, 1, 1, 3, 3, 9001]
    assert [r.start for r in got] == [0, 2, 3, 4, 7, 10]
    token_store.write_tokens(docs(spark, []), path)
    assert token_store.read_tokens(spark, path).count() == 0


# ---- token counts -----------------------------------------------------------------

def greedy(word, start, inner):
    i = n = 0
    while i < len(word):
        pieces = start if i == 0 else inner
        j = next((j for j in range(len(word), i, -1) if word[i:j] in pieces), None)
        if j is None:
            return -1
        i, n = j, n + 1
    return n


def test_automaton_against_greedy_matching():
    r = random.Random(9)
    for _ in range(200):
        start = {"".join(r.choices("abc", k=r.randint(1, 5))) for _ in range(r.randint(1, 8))}
        inner = {"".join(r.choices("abc", k=r.randint(1, 4))) for _ in range(r.randint(1, 8))}
        a = token_count.Automaton(start, inner)
        for _ in range(40):
            w = "".join(r.choices("abcd" if r.random() < 0.1 else "abc", k=r.randint(0, 12)))
            assert a.count(w) == greedy(w, start, inner), (w, start, inner)


def test_count_query_against_greedy_matching(spark):
    """The words of all texts; the model's own pieces, bare mark and bytes included."""
    want = model_greedy()
    got = {r.doc_id: r for r in queries.op6_token_counts(spark, SF).collect()}
    for d in spark.read.parquet(f"{SF}/documents.parquet").collect():
        n = [want(w.decode()) for w in d.text.encode().split()]
        assert (got[d.doc_id].n_words, got[d.doc_id].n_tokens, got[d.doc_id].n_unknown) == (len(n), sum(n), 0)


def test_count_edges(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a" * 300_000), (None, "the"), (5, "the"), (5, "the")]
    got = token_count.token_counts(docs(spark, rows)).collect()
    by = {r.id: r for r in got}
    assert len(got) == 7 and [by[i].n_tokens for i in (1, 2, 3)] == [0, 0, 0] and by[4].n_words == 1 and by[None].n_tokens == by[5].n_tokens
    assert token_count.token_counts(docs(spark, [])).count() == 0


# ---- packing ----------------------------------------------------------------------

def brute_pack(lengths, sizes):
    """One document at a time: (size, contents) of the bins, as multisets."""
    left, bins = {}, []
    for n in lengths:
        left[n] = left.get(n, 0) + 1
    for n in sorted(lengths, reverse=True):
        fits = [b for b in bins if b[0] - sum(b[1]) >= n]
        if fits:
            min(fits, key=lambda b: b[0] - sum(b[1]))[1].append(n)
        else:
            bins.append([min((c for c in sizes if c >= n), key=lambda c: ((c + 64) / (n * min(left[n], c // n)), -c)), [n]])
        left[n] -= 1
    return sorted((min(c for c in sizes if c >= sum(x)), sum(x)) for _, x in bins)


def test_plan_against_one_by_one_best_fit():
    r = random.Random(10)
    for _ in range(200):
        sizes = tuple(sorted(r.sample(range(4, 30), 3)))
        lengths = [r.randint(1, max(sizes)) for _ in range(r.randint(1, 60))]
        histogram = {n: lengths.count(n) for n in lengths}
        p = packing.plan(histogram, sizes)
        ordered = np.array(sorted(lengths, reverse=True))
        bins, offset, capacity = p.place(np.arange(len(ordered)))
        used = np.bincount(bins, weights=ordered)
        got = sorted((int(capacity[bins == b][0]), int(used[b])) for b in range(p.bins))
        assert got == brute_pack(lengths, sizes), (sizes, lengths)
        for b in range(p.bins):
            place = sorted(zip(offset[bins == b], ordered[bins == b], strict=True))
            assert all(x + n == y for (x, n), (y, _) in zip(place, place[1:])) and place[0][0] == 0


def test_packing_edges(spark):
    rows = [(1, 5000), (2, None), (3, 0), (4, 10), (4, 10), (None, 7), (5, 4096), (6, 9000)]
    df = spark.createDataFrame([(i, n, 1, 2) for i, n in rows], "doc_id long, n_tokens long, bin_id long, piece long")
    got = packing.pack(df).collect()
    assert sum(r.n_tokens for r in got) == sum(n or 0 for _, n in rows)
    assert {(r.id, r.bin_id) for r in got if not r.n_tokens} == {(2, None), (3, None)}
    assert sorted(r.piece for r in got if r.id == 6) == [0, 1, 2]
    assert len({(r.bin_id, r.offset) for r in got if r.n_tokens}) == sum(r.n_tokens > 0 for r in got)
    assert packing.pack(df.limit(0)).count() == 0


def test_packing_query(spark):
    """The registered query: every text's greedy count in pieces, in the bins of one-by-one best fit, without gaps."""
    count = model_greedy()
    want = {r.doc_id: sum(count(w.decode()) for w in (r.text or "").encode().split())
            for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op8_best_fit_packing(spark, SF).collect()
    longest, pieces, bins = max(packing.CAPACITIES), {}, {}
    for r in got:
        pieces.setdefault(r.doc_id, []).append((r.piece, r.n_tokens))
        if r.n_tokens:
            bins.setdefault((r.bin_id, r.capacity), []).append((r.offset, r.n_tokens))
    assert {i: sum(n for _, n in x) for i, x in pieces.items()} == want
    for x in pieces.values():
        assert sorted(k for k, _ in x) == list(range(len(x))) and all(n == longest for _, n in sorted(x)[:-1])
    for x in bins.values():
        x.sort()
        assert [at for at, _ in x] == [sum(n for _, n in x[:k]) for k in range(len(x))]
    assert len({b for b, _ in bins}) == len(bins) and {b for b, _ in bins} == set(range(len(bins)))
    assert sorted((c, sum(n for _, n in x)) for (_, c), x in bins.items()) == brute_pack([r.n_tokens for r in got if r.n_tokens], packing.CAPACITIES)


def test_ranks_are_dense(spark):
    df = spark.range(1000).selectExpr("id % 7 as k", "id")
    rows = ranked(df, ["k", "id"], "ranks", 5).collect()
    assert [(r.k, r.id) for r in sorted(rows, key=lambda r: r._rank)] == sorted((r.k, r.id) for r in rows)
    assert sorted(r._rank for r in rows) == list(range(1000))


def test_other_tokenizers_encode_whole_texts(spark, tmp_path):
    from tokenizers import Tokenizer, models, pre_tokenizers
    assert token_store.encoder(token_store.default_tokenizer()).wordwise
    t = Tokenizer(models.WordLevel({"<unk>": 4, "Word": 5, "word": 6, ",": 7}, unk_token="<unk>"))
    t.pre_tokenizer = pre_tokenizers.Whitespace()
    path = str(tmp_path / "cased.json")
    t.save(path)
    texts = {1: "Word, word", 2: None, 3: "word Word other ,", 4: ""}
    out = str(tmp_path / "shards")
    token_store.write_tokens(docs(spark, list(texts.items())), out, tokenizer=path)
    got = {r.id: (r.start, r.n_tokens, r.ids_crc32) for r in token_store.read_tokens(spark, out).collect()}
    at = 0
    for i, text in texts.items():
        ids = np.array([*t.encode(text or "").ids, 1], dtype="<u4")
        assert got[i] == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert t.encode("Word, word").ids == [5, 7, 6]


def test_re_pair_goes_on_until_no_pair_is_frequent():
    r = np.random.default_rng(4)
    ids = r.zipf(1.3, 400_000).clip(max=2000).astype(np.uint32)
    ids = np.concatenate([ids, np.tile(ids[:50], 3000)])
    alphabet, rules, lengths, seq = token_store.re_pair(ids)
    code = seq[:-1] * (len(alphabet) + len(rules)) + seq[1:]
    pairs, first, count = np.unique(code, return_index=True, return_counts=True)
    for k in np.flatnonzero(count >= 2 * token_store.MIN_USES):  # of equal neighbours only every second place can be used
        left, right = divmod(int(pairs[k]), len(alphabet) + len(rules))
        assert left == right, (left, right, count[k])
    assert np.array_equal(token_store.Shard(alphabet, rules, lengths, seq, *[np.empty(0)] * 3).decode(), ids)


# ---- token counts by the model's own pieces ---------------------------------------

def model_greedy():
    """Greedy matching of the marked word over the model file's pieces, bytes for what has none."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=token_count.default_vocabulary())
    pieces = {sp.id_to_piece(i) for i in range(sp.get_piece_size())
              if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))}
    longest = max(map(len, pieces))

    def count(word):
        s, i, n = "▁" + word, 0, 0
        while i < len(s):
            j = next((j for j in range(min(len(s), i + longest), i, -1) if s[i:j] in pieces), None)
            i, n = (j, n + 1) if j else (i + 1, n + len(s[i].encode()))
        return n
    return count


def test_counts_against_the_models_own_pieces(spark):
    want = model_greedy()
    assert [want(w) for w in ("2024", "1,000", "2024-01-31T10:00:00Z")] == [5, 6, 21]
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    r = random.Random(12)
    letters = "2 0 , ñ Ñ ß ç ê 漢 字 語 😀 ▁ ▁▁ the ing a Z 　 \U000e0041 \U00012000".split(" ")
    texts += [(-1 - i, " ".join("".join(r.choices(letters, k=r.randint(1, 9))) for _ in range(20))) for i in range(200)]
    texts += [(-500, "漢字2024" * 5000), (-501, "2024 1,000 ñ")]
    got = {r.id: r for r in token_count.token_counts(docs(spark, texts)).collect()}
    for i, t in texts:
        n = [want(w.decode()) for w in t.encode().split()]
        assert (got[i].n_words, got[i].n_tokens, got[i].n_unknown) == (len(n), sum(n), 0), t


def test_automaton_with_bare_mark_and_bytes():
    def brute(word, start, inner, mark):
        i = n = 0
        if not any(word.startswith(p) for p in start if p):
            n = 1 if mark else 3
        else:
            i, n = max(len(p) for p in start if p and word.startswith(p)), 1
        while i < len(word):
            j = max((len(p) for p in inner if word.startswith(p, i)), default=0)
            i, n = (i + j, n + 1) if j else (i + 1, n + len(word[i].encode()))
        return n
    r = random.Random(13)
    for k in range(200):
        start = {"".join(r.choices("abß", k=r.randint(1, 5))) for _ in range(r.randint(0, 6))}
        inner = {"".join(r.choices("abß", k=r.randint(1, 4))) for _ in range(r.randint(0, 6))}
        a = token_count.Automaton({*start, ""} if k % 2 else start, inner, by_bytes=True)
        for _ in range(40):
            w = "".join(r.choices("abß漢", k=r.randint(1, 12)))
            assert a.count(w) == brute(w, start, inner, k % 2), (w, start, inner)
