"""HTML extraction, licence scan, WARC audit: brute force, edge cases."""

import hashlib
import html
import itertools
import random
import re

import numpy as np
import pytest

from hourcast.llm import common, html_extract, license_scan, queries, warc_fixity

SF = "/root/testdata/sf0.001"


# ---- html -------------------------------------------------------------------------

@pytest.fixture(scope="module")
def model():
    return html_extract.train(html_extract.labelled_pages())


def article(page):
    inner = re.search(r"<article>(.*)</article>", page, re.S)[1]
    parts = re.split(r"</?(?:p|h1)\b[^>]*>", inner)
    parts = [" ".join(html.unescape(re.sub(r"</?b>", "", x.replace("<br>", " "))).split()) for x in parts]
    return "\n\n".join(x for x in parts if x)


def test_query_finds_the_articles(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = queries.op1_html_extraction(spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r.url == pages[r.page_id].url and r.text == article(pages[r.page_id].html) and r.n_chars == len(r.text)


def test_held_out_pages(model):
    pages = html_extract.labelled_pages(200, seed=5)
    got = html_extract.main_blocks([h for h, _ in pages], model)
    pairs = [(x in blocks, x in found) for found, (h, blocks) in zip(got, pages, strict=True)
             for x in (t for t in html_extract.parse(h).text if t is not None)]
    assert sum(a == b for a, b in pairs) >= 0.98 * len(pairs)


def test_marginals_are_exact():
    r = random.Random(1)
    pages = ["<div class=ad>x y</div><p>some text.<p>more", "<ul><li><a>z</a></ul>", "<article><h1>t</h1><p>u</article>"]
    trees = [html_extract.parse(p) for p in pages]
    vocabulary = {}
    forest = html_extract.Forest.of(trees, vocabulary, grow=True)
    m = html_extract.TreeModel(vocabulary, np.array([r.gauss(0, 1) for _ in vocabulary]), np.array([r.gauss(0, 1) for _ in range(8)]).reshape(2, 2, 2))
    got, _, own = m.marginals(forest)
    n = len(forest.parent)
    total, on = 0.0, np.zeros(n)
    for states in itertools.product((0, 1), repeat=n):
        w = sum(own[i, s] for i, s in enumerate(states))
        w += sum(m.pair[int(forest.leaf[i]), states[p], states[i]] for i, p in enumerate(forest.parent) if p >= 0)
        total += np.exp(w)
        on += np.exp(w) * np.array(states)
    assert np.allclose(got, on / total)


def test_layouts(model):
    text = "A first paragraph with enough words to be read by people, and a second clause. It goes on for a while."
    page = f"""<html><body><div id=cookie-banner>We use cookies. <button>OK</button></div><header><a href=/>Site</a></header>
    <div class="sidebar"><h3>Popular</h3><ul><li><a href=1>one</a><li><a href=2>two</a></ul></div>
    <main><h1>Title &amp; more</h1><p>{text}<p>{text.upper()}&nbsp;x<br>y <script>var a = "<p>no</p>";</script>
    <div class="advert">Buy this now.</div></main><form><label>Mail</label><input></form>
    <section id="comments"><div class="comment"><b>Bob</b><p>I liked this very much, thank you for writing it.</p></div></section>
    <footer>&copy; 2020 someone</footer>"""
    assert html_extract.main_blocks([page], model) == [["Title & more", text, f"{text.upper()} x y"]]


def test_html_edges(spark, model):
    odd = [None, "", "<", "plain text only, with no tag at all but words.", "<p>" * 3000 + "deep", "<div>" * 3000 + "deep text", "<!-- never closed <p>x",
           "<script>never closed", "<a href='x>unquoted <p>t</p>", "</div></p><p>&#x41;&bogus;&amp;lt;</p>", "<table><tr><td>a<td>b", "<p>" + "w " * 300_000]
    df = spark.createDataFrame([(i, None, h, 1, "t") for i, h in enumerate(odd)] + [(None, "u", "<p>x", 1, "t")], "page_id long, url string, html string, n_chars int, text string")
    got = {r.id: r for r in html_extract.extract(df, model).collect()}
    assert len(got) == len(odd) + 1 and got[0].text == "" and got[1].n_chars == 0
    assert html_extract.extract(df.limit(0), model).count() == 0
    assert html_extract.parse(odd[9]).text[-1] == "A&bogus;&lt;"
    assert [t for t in html_extract.parse(odd[10]).text if t] == ["a", "b"]


A, B = "First words of the page, which say something about it and then end here.", "Second words of the page, which say something else and then end there."


@pytest.mark.parametrize("page,blocks", [
    (f'<p class="a"">{A}</p><p class="b">{B}</p>', [A, B]),
    (f"<p><a title=it's>{A}</a></p><p>{B} It's over.</p>", [A, B + " It's over."]),
    (f"<p>{A}</p><video src=x><p>{B}</p>", [A, B]),
    (f"<p>{A}</p><svg><circle r=1><p>{B}</p><svg><text>no</text></svg>", [A, B]),
    (f"<p>{A}</p><object><object>no</object>no</object><audio controls>no</audio><canvas>no</canvas><p>{B}</p>", [A, B]),
    (f"<p>{A}</p><p>{B} <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>no</annotation></math></p>", [A, B + " x=2"]),
    (f"<div hidden>no</div><p>{A}</p><p style='color:red;display: none'>no</p><p>{B}<span hidden> no</span></p>", [A, B]),
    (f'<p>{A}</p><div class="hidden" aria-hidden="x"><p>{B}</p></div>', [A, B]),
    (f"<script src=https://x/>code</script><p>{A}</p><script src='x' />{B}", [A, B]),
    (f"<p title='a > b' data-x=\"it's\">{A}</p ><p title = \"x\">{B}", [A, B]),
    (f"<p a='unclosed>{A}</p><p>{B}", [A, B]),
    (f"<p ='x'>{A}</p><br/><p/>{B}", [A, B])])
def test_tags_as_browsers_read_them(page, blocks):
    assert [t for t in html_extract.parse(page).text if t] == blocks


def test_many_unclosed_elements_take_linear_time():
    page = "<svg><video src='x><a b=\"c><object hidden" * 20_000 + f"><p>{A}</p>"
    assert html_extract.parse(page) is not None


# ---- licences ---------------------------------------------------------------------

def brute_scan(files):
    space = license_scan.Space(license_scan.TEMPLATES)
    vocabulary = set(space.words.to_pylist())
    words = lambda t: [w for w in (x.strip(license_scan.PUNCTUATION) for x in t.lower().split()) if w]
    lines = [x for _, _, t in files for x in (t or "").split("\n") if x.strip()]
    idf = {w: 1 + np.log((1 + len(lines)) / (1 + sum(w in words(x) for x in lines))) for w in vocabulary}

    def vector(t):
        v = {}
        for w in words(t):
            v[w] = v.get(w, 0) + 1
        other = sum(n for w, n in v.items() if w not in vocabulary)
        return {w: n * idf[w] for w, n in v.items() if w in vocabulary}, other

    template = {tt: vector(tt) for ts in license_scan.TEMPLATES.values() for tt in ts}

    def cosine(a, b):
        (x, ox), (y, oy) = a, template[b]
        size = np.sqrt((sum(i * i for i in x.values()) + ox) * (sum(i * i for i in y.values()) + oy))
        return sum(i * y.get(w, 0) for w, i in x.items()) / size if size else 0
    def named(part, scored):
        top = max(v for v, _, _ in scored)
        near = {}
        for v, name, tt in scored:
            if v >= top - license_scan.NEAR and (name not in near or v > near[name][0]):
                near[name] = (v, tt)
        has = set(words(part))
        for name, (_, tt) in near.items():
            for other, (_, rival) in near.items():
                tell = (set(words(tt)) ^ set(words(rival)))
                agree = sum(idf[w] ** 2 * (1 if (w in has) == (w in words(tt)) else -1) for w in tell)
                if other != name and (not tell or agree < license_scan.MARGIN * sum(idf[w] ** 2 for w in tell)):
                    break
            else:
                return name
        return license_scan.AMBIGUOUS
    out = {}
    for i, _, t in files:
        found = []
        blocks = [x for x in re.split(r"\n[ \t\r]*\n", t or "") if "\n" in x.strip()]
        for part in [x for x in (t or "").split("\n") if x.strip()] + blocks + [t or ""]:
            if not set(words(part)) & vocabulary:
                continue
            mine = vector(part)
            scored = [(cosine(mine, tt), name, tt) for name, ts in license_scan.TEMPLATES.items() for tt in ts]
            top = max(v for v, _, _ in scored)
            if top >= license_scan.MIN_SCORE:
                name = named(part, scored)
                found.append((name == license_scan.AMBIGUOUS, -top, name))
        out[i] = (-min(found)[1], min(found)[2]) if found else (0, None)
    return out


def test_scan_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    known = license_scan.NOTICES
    files = [(r.doc_id, "x", r.text) for r in rows][:80] + [
        (900, "x", known["MIT"][0].replace(", ", ",\n")), (901, "x", "Licensed under the Apache License"), (902, "x", None),
        (903, "x", known["BSD-2-Clause"][0]), (904, "x", known["BSD-3-Clause"][1].replace(". ", ".\n")), (905, "x", ""),
        (906, "x", "Licensed under the GNU General Public License.\n\nReleased under the ISC License.")]
    want = brute_scan(files)
    got = license_scan.scan(spark.createDataFrame(files, "doc_id long, path string, text string")).collect()
    assert {r.id: r.own for r in got} == {i: name for i, (_, name) in want.items()}
    assert all(abs(r.score - want[r.id][0]) < 1e-9 for r in got)
    own = {r.id: r.own for r in got}
    assert (own[900], own[903], own[904], own[906]) == ("MIT", license_scan.AMBIGUOUS, "BSD-3-Clause", "ISC")


GNU = ("This program is free software; you can redistribute it and/or modify it under the terms of the {} as published by the Free "
       "Software Foundation; either version {} of the License, or (at your option) any later version.")


def test_near_licences_are_told_apart(spark):
    known = license_scan.NOTICES
    texts = {GNU.format("GNU General Public License", "2"): "GPL-2.0", GNU.format("GNU General Public License", "3"): "GPL-3.0",
             GNU.replace("program", "library").format("GNU Lesser General Public License", "2.1"): "LGPL-2.1",
             GNU.replace("program", "library").format("GNU Lesser General Public License", "3"): "LGPL-3.0",
             GNU.format("GNU Affero General Public License", "3"): "AGPL-3.0", "GNU GENERAL PUBLIC LICENSE\nVersion 2, June 1991": "GPL-2.0",
             "Licensed under CC BY-ND 4.0.": "CC-BY-ND-4.0", "Licensed under CC BY 4.0.": "CC-BY-4.0", "Licensed under CC BY 3.0.": "CC-BY-3.0",
             "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.": "CC-BY-ND-4.0",
             "SPDX-License-Identifier: MIT": "MIT", "// SPDX-License-Identifier: GPL-2.0-only": "GPL-2.0", "Licensed under the MIT license.": "MIT",
             "# SPDX-License-Identifier: LGPL-2.1-or-later": "LGPL-2.1", known["ISC"][0]: "ISC", known["BSD-2-Clause"][1]: "BSD-2-Clause",
             known["BSD-3-Clause"][1]: "BSD-3-Clause", known["BSD-3-Clause"][0]: license_scan.AMBIGUOUS,
             "This work is licensed under the GNU General Public License.": license_scan.AMBIGUOUS,
             "Licensed under the terms of the Apache License, Version 2.0": "Apache-2.0", "All rights reserved.": "proprietary"}
    plain = ["This is prose number %d about the public work of a version of the law." % k for k in range(300)]
    rows = list(enumerate([*texts, *plain, " ".join(f"word{k}" for k in range(200_000)) + "\n" + list(texts)[0]]))
    df = spark.createDataFrame([(i, "p", t, "x", 0.5) for i, t in rows], "doc_id long, path string, text string, own string, score double")
    got = {r.id: r.own for r in license_scan.scan(df).collect()}
    assert [(t, got[i]) for i, t in rows if i < len(texts)] == list(texts.items())
    assert {got[i] for i, _ in rows[len(texts):-1]} == {None} and got[len(rows) - 1] == "GPL-2.0"


def test_ties_in_a_directory(spark):
    """Of equal licence files the smallest path counts, then the name; a file that names its licence goes before an ambiguous one."""
    files = [(1, "a/LICENSE", license_scan.NOTICES["BSD-2-Clause"][0]), (2, "a/NOTICE", "Licensed under CC BY 1.0"), (3, "a/COPYING", "Licensed under the terms of the MIT License."),
             (4, "a/x.txt", "x"), (5, "b/NOTICE", "Released under the ISC License."), (6, "b/LICENSE", "Released under the MIT License."), (7, "b/x.txt", "x"),
             (8, "c/LICENSE", "Released under the MIT License."), (9, "c/LICENSE", "Released under the ISC License."), (10, "c/x.txt", None), (10, "c/x.txt", None)]
    got = {r.id: (r.license, r.license_from) for r in license_scan.inherit(license_scan.scan(spark.createDataFrame(files, "doc_id long, path string, text string"))).collect()}
    assert (got[4], got[7], got[10]) == (("MIT", "a/COPYING"), ("MIT", "b/LICENSE"), ("ISC", "c/LICENSE"))


@pytest.mark.parametrize("hot_rows", [1 << 20, 1])
def test_inheritance(spark, monkeypatch, hot_rows):
    monkeypatch.setattr(common, "HOT_ROWS", hot_rows)
    lic = {"MIT": "Released under the MIT License.", "Apache-2.0": "Licensed under the Apache License, Version 2.0.", "GPL-3.0": "This work is licensed under the GNU General Public License, version 3."}
    files = [(1, "LICENSE", lic["MIT"]), (2, "a/b/c.txt", "plain prose"), (3, "a/LICENSE.md", "words\n" + lic["Apache-2.0"]), (4, "a/b/own.txt", " ".join(f"word{k}" for k in range(400)) + "\n" + lic["GPL-3.0"]),
             (5, "z/q.txt", "x"), (6, None, "x"), (7, "a/b/d/e.txt", None), (8, "a/b/d/LICENSE", "nothing known"), (5, "z/q.txt", "x"), (9, "top.txt", "")]
    df = spark.createDataFrame([(i, p, t, "other", 1) for i, p, t in files], "doc_id long, path string, text string, license string, up int")
    got = {(r.id, r.license, r.license_from, r.levels_up) for r in license_scan.inherit(license_scan.scan(df)).collect()}
    assert got == {(1, "MIT", "LICENSE", 0), (2, "Apache-2.0", "a/LICENSE.md", 1), (3, "Apache-2.0", "a/LICENSE.md", 0), (4, "GPL-3.0", "a/b/own.txt", 0),
                   (5, "MIT", "LICENSE", 1), (6, None, None, None), (7, "Apache-2.0", "a/LICENSE.md", 2), (8, "Apache-2.0", "a/LICENSE.md", 2), (9, "MIT", "LICENSE", 0)}
    assert license_scan.inherit(license_scan.scan(df.limit(0))).count() == 0


def test_license_query_finds_planted_lines(spark):
    got = {r.doc_id: r for r in queries.op3_license_scan(spark, SF).collect()}
    planted = {"Licensed under the Apache License, Version 2.0.": "Apache-2.0", "Released under the MIT License.": "MIT", "All rights reserved.": "proprietary",
               "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0"}
    seen = 0
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        own = {planted[x] for x in r.text.split("\n") if x in planted}
        seen += bool(own)
        assert (got[r.doc_id].own in own) if own else got[r.doc_id].own is None
    assert seen and len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()


# ---- warc -------------------------------------------------------------------------

def test_record_bytes(spark):
    df = spark.createDataFrame([(2, "http://x/", "é"), (1, None, None), (2, "http://x/", "é")], "page_id long, url string, html string")
    rows = sorted(warc_fixity.records(df, file_records=2).collect(), key=lambda r: (r.file, r.number))
    assert [(r.file, r.number, r.id) for r in rows] == [(0, 0, 1), (0, 1, 2), (1, 2, 2)]
    assert bytes(rows[0].record) == b"WARC/1.0\r\nWARC-Type: response\r\nContent-Type: text/html\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
    assert bytes(rows[1].record) == "WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: http://x/\r\nContent-Type: text/html\r\nContent-Length: 2\r\n\r\né\r\n\r\n".encode()


def test_audit_against_brute_force(spark):
    r = random.Random(3)
    first = {(f, n): r.randbytes(r.randint(20, 90)) for f in range(3) for n in range(f * 40, f * 40 + r.choice([1, 17, 40]))}
    second = dict(first)
    for k in r.sample(sorted(first), 6):
        second[k] = hashlib.md5(first[k]).digest()
    for k in r.sample(sorted(first), 4):
        second.pop(k)
    second[7, 900] = b"extra file"
    second[0, 39_000] = b"extra record"
    read = lambda d: spark.createDataFrame([(f, n, b) for (f, n), b in d.items()], "file long, number long, record binary")
    want = set()
    for f in {f for f, _ in first}:
        at = 0
        for k in sorted(k for k in first if k[0] == f):
            if first[k] != second.get(k):
                want.add((*k, at, len(first[k]), "changed" if k in second else "missing"))
            at += len(first[k])
    want |= {(*k, None, len(second[k]), "extra") for k in second if k not in first}
    got = warc_fixity.audit(read(first), read(second), range_bytes=64, fanout=2, levels=3)
    assert {tuple(x) for x in got.collect()} == want
    assert warc_fixity.audit(read(first), read(first)).count() == 0


def test_audit_of_repeated_and_many_extra_records(spark):
    r = random.Random(4)
    first = [(0, n, r.randbytes(30)) for n in range(60)] + [(1, 5, None), (1, 9, b"x" * 3_000_000)]
    first += [(0, 7, first[7][2])] * 2 + [(0, 8, b"another")] + [(0, 50, first[50][2])]
    second = [x for x in first if x != first[50]] + [first[50]] * 4 + [first[11]] * 3 + [(0, 8, b"another")]
    second.remove(first[7])
    second += [(0, 10 ** 12 + 997 * k, b"extra") for k in range(3000)] + [(0, 10 ** 12, b"extra")] + [(5, -3, b"below"), (1, 9, b"y")]
    read = lambda rows: spark.createDataFrame([(f, n, b, "clash", 1) for f, n, b in rows],
                                              "file long, number long, record binary, digest string, offset int")
    want, at = set(), {}
    for f, n in sorted({(f, n) for f, n, _ in first} | {(f, n) for f, n, _ in second}):
        a, b = (sorted(x or b"" for g, m, x in rows if (g, m) == (f, n)) for rows in (first, second))
        size = sum(map(len, a))
        if a != b:
            kind = "extra" if not a else "missing" if not b else "repeated" if len({*a, *b}) == 1 else "changed"
            want.add((f, n, at.get(f, 0) if a else None, size if a else sum(map(len, b)), kind))
        at[f] = at.get(f, 0) + size
    for levels in (None, 2):
        got = warc_fixity.audit(read(first), read(second), range_bytes=64, fanout=4, levels=levels).collect()
        assert {tuple(x) for x in got} == want and len(got) == len(want)
    assert {k for *_, k in want} == {"extra", "repeated", "changed"}
    kinds = {tuple(x)[-1] for x in warc_fixity.audit(read(second), read(first), range_bytes=64, fanout=4).collect()}
    assert kinds == {"missing", "repeated", "changed"}


def test_audit_of_very_long_pages(spark):
    """The last byte of a page of 24 MB, and the places of the records after it."""
    rows = [(1, "http://a/", "a" * 24_000_000), (2, "http://b/", "short"), (3, "http://c/", "é" * 5_000_000), (4, "http://d/", None)]
    archive = warc_fixity.records(spark.createDataFrame(rows, "page_id long, url string, html string"))
    size = {r.number: r.n for r in archive.selectExpr("number", "octet_length(record) as n").collect()}
    assert size[0] > 24_000_000 and size[2] > 10_000_000
    last = "concat(substring(record, 1, octet_length(record) - 5), cast('?\r\n\r\n' as binary))"
    replica = archive.selectExpr("file", "number", f"if(number in (0, 3), {last}, record) as record")
    got = warc_fixity.audit(archive, replica).collect()
    assert {tuple(x) for x in got} == {(0, 0, 0, size[0], "changed"), (0, 3, sum(size[k] for k in range(3)), size[3], "changed")}


def test_audit_of_nothing(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    a = warc_fixity.records(empty)
    assert a.count() == 0 and warc_fixity.audit(a, a).count() == 0
