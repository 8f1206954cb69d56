"""Quality rules, language ID, decontamination: brute force, edge cases, held-out accuracy."""

import collections
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from hourcast.llm import decontaminate, langid, quality, queries

SF = "/root/testdata/sf0.001"
CLASH = "doc_id long, text string, lang string, source string, n_chars long, id long, kept boolean, n_words long, TEXT_ string, t string"


def docs(spark, texts, schema="doc_id long, text string, lang string, source string, n_chars long"):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in texts], schema)


# ---- quality ------------------------------------------------------------------

STOPS = ".!?…。！？｡।॥؟۔։።፧။།"
END = re.compile("[.!?…][\"'»”’)\\]]*([\\x20\\x09-\\x0D]|\\Z)")


def line_fails(x):
    n = len(re.findall(r"[^\x20\x09-\x0D]+", x))
    seps, syms = sum(c in "|»›·•>" for c in x), sum(c in "#*$%&|<>" for c in x)
    ends = END.search(x) or any(c in STOPS[4:] for c in x) or re.search("[ก-๛ກ-ໟ]{20}", x)
    sentences = re.split(f"[{STOPS}]", x)
    stock = sum(len(p) for p in sentences if re.search(quality.BOILERPLATE, p))
    return (not ends or seps >= 3 and seps * 4 >= n or syms * 2 > n
            or bool(re.search(quality.BOILERPLATE, x)) and 2 * stock >= sum(map(len, sentences)))


def brute_quality(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = collections.Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    hit = set()
    for i in range(len(w) - 7):
        if windows[tuple(w[i:i + 8])] > 1:
            hit |= set(range(i, i + 8))
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    base = len(w) < 20 or 100 * len(hit) > 30 * len(w)
    lost = sum(len(re.sub(r"[\x20\x09-\x0D]", "", x)) for x in lines if line_fails(x))
    chars = sum(map(len, w))
    return (len(w), chars, sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit), base,
            not base and lost <= 0.5 * chars)


def test_quality_sql(spark):
    """The registered query against its SQL, on the given table and on lines the given table lacks."""
    r = random.Random(8)
    words = ["alpha", "beta.", "gamma!", "字。", "है।", "|", "#", "privacy policy", "all rights reserved.", "ก" * 25, "؟", "we use cookies"]
    rows = [(i, "".join(r.choice(words) + r.choice(" \n ") for _ in range(r.randint(1, 120)))) for i in range(150)]
    rows += [(900, ("word " * 100 + "ends. ") * 30 + "Privacy policy."), (901, "We use cookies " + "and more " * 300 + "of them."), (902, None), (902, "")]
    given = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    both = given.unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    con = duckdb.connect()
    documents = both.toArrow()  # noqa: F841
    con.register("documents", documents)
    want = con.execute(queries.ORACLE_SQL["op9_quality_rules"]).fetchall()
    names = [c[0] for c in con.description]
    got = quality.cleaned(both).withColumnRenamed("id", "doc_id").select(names).collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter(want)


def test_quality_against_brute_force(spark):
    r = random.Random(3)
    vocabulary = ["a", "bb", "the", "ẞü", "x.", "y!", "|", "#", "&", "z", "字。", "है।", "privacy policy", "all rights reserved.", "؟"]
    texts = ["", " ", "\n\n", None, "one two", "All rights reserved.", "a " * 500, "a b c d e f g h " * 4 + "."]
    for _ in range(60):
        texts.append("".join(r.choice(vocabulary) + r.choice([" ", " ", " ", "\n", "\t", "\x0b", " "]) for _ in range(r.randint(1, 200))))
    long_line = " ".join(r.choice(["alpha", "beta", "gamma", "delta."]) for _ in range(30_000))
    texts += [long_line, texts[9], texts[9]]
    got = quality.cleaned(docs(spark, enumerate(texts))).orderBy("id").collect()
    for row, t in zip(got, texts, strict=True):
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words, row.base_failed, row.kept) == brute_quality(t), t


def test_quality_keeps_prose_and_takes_lines_out(spark):
    prose = "This is a clean line of plain prose that says something and ends. " * 1
    other = "Here is another line with different words, which also comes to an end!"
    text = "\n".join(["Home | About | Contact | Help", prose + "More of it follows in its own words.", other, "All rights reserved."])
    row = quality.cleaned(docs(spark, [(1, text)])).first()
    assert row.kept and row.n_removed == 2 and "Home" not in row.clean_text and other in row.clean_text


def test_quality_edges(spark):
    assert quality.cleaned(docs(spark, [])).count() == 0
    clash = spark.createDataFrame([(None, None, None, None, None, 5, True, 7, "x", "y"), (1, "a b", "en", "s", 3, None, None, None, None, None)], CLASH)
    got = {r.id: r for r in quality.cleaned(clash).collect()}
    assert got[None].n_words == 0 and got[None].base_failed and not got[None].kept and got[1].n_words == 2


def test_quality_takes_out_long_boilerplate(spark):
    prose = "This is a clean line of plain prose that says something new and then comes to its end, as lines of prose should do."
    cookies = "We use cookies and similar techniques to make this site work, to measure how it is used and to show you what may be of interest, " \
              "and we share what we learn with partners who may join it with what you have told them or what they have gathered elsewhere."
    assert len(cookies) > 200
    short, lost = prose + "\n" + cookies[:150] + ".", prose + "\n" + cookies
    got = {r.id: r for r in quality.cleaned(docs(spark, [(1, short), (2, lost), (3, prose + " " + prose.upper())])).collect()}
    assert [got[i].n_removed for i in (1, 2, 3)] == [1, 1, 0]
    assert got[2].clean_text == prose and not got[2].kept and got[3].kept


def test_quality_of_other_scripts_and_long_prose(spark):
    chinese = "\n".join("这是一个很长的句子，它讲述了一个故事。然后 它 结束了。" for _ in range(8)).replace("一个", "一个 ")
    hindi = "यह एक लंबा वाक्य है जो एक कहानी बताता है। फिर यह समाप्त हो जाता है और हम सब घर चले जाते हैं।"
    arabic = "هل هذه جملة طويلة تحكي قصة عن المدينة القديمة التي كنا نعيش فيها منذ زمن بعيد جدا مع كل الاصدقاء والجيران؟"
    thai = "นี่คือประโยคยาวที่เล่าเรื่องราวหนึ่ง แล้วมันก็จบลง " + " ".join(f"คำที่{k}" for k in range(20))
    mention = "The town council met on Monday to talk about the new library. Its privacy policy came up for a while. Then they went home, as it was late and they were tired."
    texts = [chinese, hindi, arabic, thai, mention + " " + mention.upper(), "menu one two three " * 6, hindi.replace("।", "")]
    texts += [" ".join(f"word{k}" for k in range(500)) + ". We use cookies.", " ".join(f"word{k}" for k in range(500)) + " we use cookies."]
    got = {r.id: r for r in quality.cleaned(docs(spark, enumerate(texts))).collect()}
    assert {i: got[i].n_removed for i in got} == {0: 0, 1: 0, 2: 0, 3: 0, 4: 0, 5: 1, 6: 1, 7: 0, 8: 1}
    assert [got[i].kept for i in range(5)] == [not got[i].base_failed for i in range(5)] and all(got[i].kept for i in (1, 2, 3, 4, 7))
    for i, t in enumerate(texts):
        assert (got[i].base_failed, got[i].kept) == brute_quality(t)[-2:]


# ---- language -----------------------------------------------------------------

def test_language_held_out_accuracy(spark):
    rows = queries.op10_language_id(spark, "/root/testdata/sf0.01").collect()
    truth = {r.doc_id: r for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    right = sum(r.lang_pred == truth[r.doc_id].lang for r in held)
    assert right >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def small_net(spark):
    r = random.Random(1)
    parts = {"aa": ["bal", "ka", "mo"], "bb": ["ü", "sch", "ei"]}
    data = [(i, " ".join("".join(r.choices(parts[lang], k=3)) for _ in range(30)), lang, "s", 0)
            for i, lang in enumerate(["aa", "bb"] * 60)]
    return langid.train(spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long"))


def test_language_edges(spark):
    net = small_net(spark)
    assert net.languages == ["aa", "bb"]
    d = spark.createDataFrame([(1, None, 3), (2, "", 3), (3, "12 34 %%", 3), (4, "balka mo " * 40_000, 3), (5, "scheiü", 3), (None, "balmo", 3), (5, "scheiü", 3)],
                              "doc_id long, text string, score long")
    rows = langid.predict(d, net).collect()
    got = {r.id: r for r in rows}
    assert len(rows) == 7
    assert [got[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and got[1].score == 0
    assert got[4].lang_pred == "aa" and got[5].lang_pred == "bb" and got[None].lang_pred == "aa"
    assert langid.predict(d, None).where("lang_pred = 'und'").count() == 7
    assert langid.train(d.limit(0).selectExpr("doc_id", "text", "'x' as lang")) is None
    assert langid.predict(d.limit(0), net).count() == 0


def test_every_language_is_learned(spark):
    letters = [chr(0x4E00 + 40 * i) + chr(0x4E00 + 40 * i + 7) for i in range(150)]
    data = [(i * 20 + k, (pair + " ") * 12, f"l{i:03d}") for i, pair in enumerate(letters) for k in range(2 if i else 20)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string")
    net = langid.train(df, per_language=4)
    assert net.languages == [f"l{i:03d}" for i in range(150)]
    assert langid.train(df.selectExpr("doc_id", "text", "cast(null as string) as lang")) is None


def test_tables_are_the_convolution():
    net = langid.ByteCNN(["a", "b", "c"], window=32)
    x = np.random.default_rng(0).integers(0, 256, (5, 32)).astype(np.uint8)
    _, _, _, p = net._forward(x)
    assert np.allclose(np.log(p), net.log_probabilities(x, net.tables()), atol=1e-4)


def test_windows_count_by_their_bytes():
    """A text's prediction: the mean of its windows' log probabilities by bytes, one window at a time."""
    net, r = langid.ByteCNN(["a", "b", "c"], window=32), random.Random(12)
    texts = ["".join(r.choices("abc ñ字.", k=n)) + "x" for n in [0, 1, 30, 31, 32, 33, 62, 63, 64, 65, 500, 3000]] + [None, "", "12 34"]
    lang, score = langid._predict(pa.array(texts, pa.string()), net, net.tables())
    for text, got, p in zip(texts, lang, score, strict=True):
        if not any(c.isalpha() for c in text or ""):
            assert (got, p) == ("und", 0)
            continue
        data, total = text.encode(), np.zeros(3)
        for a in range(0, len(data), 32):
            part = data[a:a + 32]
            x = np.frombuffer(part.ljust(32, b"\0"), dtype=np.uint8)[None, :]
            total += len(part) * np.log(net._forward(x)[3][0])
        want = np.exp(total / len(data))
        want /= want.sum()
        assert got == net.languages[int(want.argmax())] and abs(p - want.max()) < 1e-4


def test_equal_probabilities_go_to_the_first_language():
    net = langid.ByteCNN(["b", "c", "d"], window=32)
    net.params["U"][:] = 0
    lang, score = langid._predict(pa.array(["some words", "x" * 400]), net, net.tables())
    assert lang == ["b", "b"] and np.allclose(score, 1 / 3)


def test_training_gradient():
    net = langid.ByteCNN(["a", "b"], window=16, embed=3, filters=2, widths=(2, 3))
    net.params = {k: v.astype(np.float64) for k, v in net.params.items()}
    r = np.random.default_rng(0)
    x, y = r.integers(0, 256, (4, 16)).astype(np.uint8), np.array([0, 1, 1, 0])
    loss = lambda: -np.log(net._forward(x)[3][np.arange(4), y]).mean()
    g = net._gradients(x, y)
    for k in ("U", "W2", "W3", "b2", "c"):
        at = tuple(0 for _ in net.params[k].shape)
        old = net.params[k][at]
        net.params[k][at] = old + 1e-5
        up = loss()
        net.params[k][at] = old - 1e-5
        down = loss()
        net.params[k][at] = old
        assert abs((up - down) / 2e-5 - g[k][at]) < 1e-6, k


# ---- decontamination ------------------------------------------------------------

def brute_tiles(a, b, m):
    used_a, used_b, found = set(), set(), []
    while True:
        best = None
        for i in range(len(a)):
            for j in range(len(b)):
                k = 0
                while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k] and i + k not in used_a and j + k not in used_b:
                    k += 1
                if k >= m and (best is None or k > best[0]):
                    best = (k, i, j)
        if best is None:
            return found
        found.append(best)
        used_a |= set(range(best[1], best[1] + best[0]))
        used_b |= set(range(best[2], best[2] + best[0]))


def test_tiling_against_brute_force():
    r = random.Random(5)
    for _ in range(150):
        a = np.array([r.randrange(3) for _ in range(r.randrange(1, 24))])
        b = np.array([r.randrange(3) for _ in range(r.randrange(1, 40))])
        m = r.randrange(1, 5)
        want = brute_tiles(a.tolist(), b.tolist(), m)
        assert decontaminate.tiles(a, b, m) == want
        seeds = [(i, j) for i in range(len(a) - m + 1) for j in range(len(b) - m + 1) if (a[i:i + m] == b[j:j + m]).all()]
        if seeds:
            assert decontaminate.tiles(a, b, m, *map(np.array, zip(*seeds, strict=True))) == want


def words(text):
    return [w for w in (x.strip(decontaminate.PUNCTUATION) for x in text.lower().split()) if w]


def test_overlaps_against_brute_force(spark, monkeypatch):
    r = random.Random(8)
    v = [f"w{i}" for i in range(6)] + ["The", "of,"]
    items = [(i, " ".join(r.choices(v, k=r.choice([2, 4, 8, 15, 25])))) for i in range(12)] + [(12, None), (13, "  "), (3, "x y"), (None, "q r s t u v")]
    texts = [(i, " ".join(r.choices(v, k=r.choice([0, 3, 30, 60])))) for i in range(25)]
    passage = items[3][1].split()
    texts += [(90, " ".join(passage[len(passage) // 2:] + ["filler"] + passage[:len(passage) // 2])), (91, None), (92, "q R s, t u v"),
              (92, "q R s, t u v"), (None, "X y")]
    d = docs(spark, texts)
    b = spark.createDataFrame(items, "item_id long, text string")
    want = collections.Counter()
    for i, t in texts:
        for k, item in set(items):
            x, y = words(item or ""), words(t or "")
            if x:
                covered = sum(n for n, _, _ in brute_tiles(x, y, min(5, len(x))))
                if covered >= 0.5 * len(x):
                    want[i, k, len(x), covered] += 1
    read = lambda **kw: collections.Counter((r.id, r.item_id, r.item_tokens, r.covered) for r in decontaminate.overlaps(d, b, **kw).collect())
    assert want and read() == want
    assert read(block_bytes=64) == want and len(list(decontaminate.blocks(b, "item_id", "text", 5, 64))) > decontaminate.BLOCKS_HELD
    block = decontaminate.Block.build([(k, t) for k, t in set(items) if t is not None], 5)
    hits = [(row, block.item_ids[k], c) for row, k, c, *_ in block.overlaps(*decontaminate.tokens(pa.array([t for _, t in texts])), 0.5)]
    monkeypatch.setattr(decontaminate, "MAX_HITS", 3)
    assert sorted(hits, key=str) == sorted([(row, block.item_ids[k], c) for row, k, c, *_ in block.overlaps(*decontaminate.tokens(pa.array([t for _, t in texts])), 0.5)], key=str)
    for size in (decontaminate.BLOCK_BYTES, 64):
        clean = {r.doc_id for r in decontaminate.without_leaks(d, b, block_bytes=size).collect()}
        assert clean == {i for i, _ in texts} - {k[0] for k in want}


def test_one_python_stage_for_all_blocks(spark):
    d = docs(spark, [(1, "x")])
    b = spark.createDataFrame([(i, f"item {i} with a few words of its own " * 3) for i in range(60)], "item_id long, text string")
    for out in (decontaminate.overlaps(d, b, block_bytes=256), decontaminate.without_leaks(d, b, block_bytes=256)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("MapInArrow") == 1 and "Union" not in plan and out.count() in (0, 1)


def test_decontamination_of_clashing_names(spark):
    """The first column of a name counts; without_leaks returns every column as it came."""
    item = "alpha beta gamma delta epsilon zeta eta theta"
    rows = [(1, f"so {item} it is", "a", 1, 0.5, "p"), (2, "nothing of the kind is here", item, 2, 0.5, "q"), (2, "nothing of the kind is here", item, 2, 0.5, "q")]
    d = spark.createDataFrame(rows, "doc_id long, text string, TEXT string, id int, coverage double, item string").toDF("doc_id", "text", "text", "id", "coverage", "item_id")
    b = spark.createDataFrame([(7, item, "no words shared", 3)], "item_id long, text string, extra string, id int").toDF("item_id", "text", "text", "id")
    assert [(r.id, r.item_id) for r in decontaminate.overlaps(d, b).collect()] == [(1, 7)]
    kept = decontaminate.without_leaks(d, b)
    assert kept.columns == d.columns and [tuple(r) for r in kept.collect()] == rows[1:]


def test_decontamination_query_against_brute_force(spark):
    """All (document, item) pairs of the query's tables."""
    read = lambda name: spark.read.parquet(f"{SF}/{name}.parquet")
    items = [(r.item_id, words(r.text or "")) for r in read("benchmark").distinct().collect()]
    got = {(r.doc_id, r.item_id, r.covered) for r in queries.op2_benchmark_decontamination(spark, SF).collect()}
    want = set()
    for r in read("documents").collect():
        doc = words(r.text or "")
        grams = {}
        for k in range(len(doc) - 4):
            grams.setdefault(tuple(doc[k:k + 5]), []).append(k)
        for i, item in items:
            shared = [k for k in range(len(item) - 4) if tuple(item[k:k + 5]) in grams]
            if 2 * len({k + j for k in shared for j in range(5)}) >= len(item) > 0:
                spots = sorted({s for k in shared for s in grams[tuple(item[k:k + 5])]})
                part = [w for s in sorted({s + j for s in spots for j in range(5)}) for w in ([] if s - 1 in {x + j for x in spots for j in range(5)} else [None]) + [doc[s]]]
                covered = sum(n for n, _, _ in brute_tiles(item, part, 5))
                if 2 * covered >= len(item):
                    want.add((r.doc_id, i, covered))
    assert want and got == want


def test_decontamination_edges(spark):
    d, b = docs(spark, [(1, "a b c d e f")]), spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.overlaps(d, b).count() == 0 and decontaminate.without_leaks(d, b).count() == 1
    b = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert decontaminate.overlaps(d.limit(0), b).count() == 0 and decontaminate.without_leaks(d, b).count() == 0
    long_text = "the " * 60_000 + "a b c d e f"
    assert decontaminate.overlaps(docs(spark, [(1, long_text)]), spark.createDataFrame([(1, "the " * 40)], "item_id long, text string")).count() == 1


@pytest.mark.parametrize("moved", [False, True])
def test_moved_passages_are_found(spark, moved):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi"
    w = item.split()
    text = " ".join((w[8:] + ["and"] + w[:8]) if moved else w)
    got = decontaminate.overlaps(docs(spark, [(1, f"before it {text} after it")]), spark.createDataFrame([(7, item)], "item_id long, text string")).collect()
    assert [(r.item_id, r.covered, r.n_tiles) for r in got] == [(7, 16, 1 + moved)]
