"""Mixing, chat formatting, token counts, quality, licences, vectors and pages against plain versions."""

import math
import random
import zlib

import numpy as np
import plain
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import chat, grid_join, licenses, mixing, quality, separators, site_templates
from ledgerloom.llm.common import WORD, Scratch


# ---- mixing


def _targets(sizes):
    """Shares by repeated resharing of what exceeds twice the size."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    budget, full = 1.5 * sum(sizes.values()), {}
    while True:
        open_ = [s for s in order if s not in full]
        left = budget - sum(full.values())
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = [s for s in open_ if share[s] > 2 * sizes[s]]
        if not over:
            return full | share
        full |= {s: 2 * sizes[s] for s in over}


def test_mix(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 20)
    draw = random.Random(1)
    rows = [(i, " ".join("w" * draw.choice([0, 1, 5, 40, 200])) or None, draw.choice(["a", "a", "a", "é", "z", "B", None])) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    run = lambda: mixing.mix(docs, F.regexp_count("text", F.lit(WORD)), mixing.quality_weight("text")).collect()
    found = run()
    assert sorted(map(str, found)) == sorted(map(str, run()))
    text = {i: t for i, t, _ in rows}
    sizes = {}
    for i, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(plain.words(t))
    expected = _targets(sizes)
    taken = {}
    for r in found:
        assert r["size"] == len(plain.words(text[r.doc_id])) and r.taken == r["size"] * r.copies <= 2 * r["size"]
        assert r.source_size == sizes[r.source] and math.isclose(r.target, expected[r.source], rel_tol=1e-9)
        taken[r.source] = taken.get(r.source, 0) + r.taken
        # complete epochs come first
        assert r["size"] == 0 or r.copies >= int(r.target // r.source_size)
    assert all(abs(taken[s] - expected[s]) <= 100 for s in sizes)


def test_mix_prefers_quality(spark):
    docs = spark.range(4000).selectExpr("id as doc_id", "'s' as source", "if(id % 2 = 0, 1.0, 0.1) as quality")
    found = mixing.mix(docs, F.lit(1), F.col("quality"), share=0.3).collect()
    good = sum(r.copies for r in found if r.doc_id % 2 == 0)
    assert abs(sum(r.copies for r in found) - 1200) <= 1 and good > 900


def test_mix_awkward(awkward, empty):
    size = F.regexp_count("text", F.lit(WORD))
    found = mixing.mix(awkward, size, F.lit(None).cast("double")).collect()
    assert len(found) == awkward.count() and all(r.copies == 0 for r in found if r["size"] == 0)
    assert mixing.mix(empty, size, F.lit(1.0)).count() == 0


# ---- chat


def test_chat_round_trip(spark):
    draw = random.Random(4)
    alphabet = ["<turn>", "</turn>\n", "\\", "\\l", "\\b", "\\n", "<", "\n", "é", "世", "a b", "<image 0>", ""]
    turns = []
    for c in range(30):
        for t in range(draw.randint(1, 9)):
            role = draw.choice(["user", "assistant", "system", "a\nb<\\n", None])
            turns.append((c, t, role, None if draw.random() < 0.1 else "".join(draw.choices(alphabet, k=draw.randint(0, 6)))))
    table = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")
    chats = chat.format_chats(table.withColumn("parts", chat.text_parts(F.col("text")))).cache()
    for r in chats.collect():
        own = [(x[2] or "", x[3] or "") for x in turns if x[0] == r.conv_id]
        back = chat.read_back(chats.filter(F.col("conv_id") == r.conv_id)).orderBy("n").collect() if r.conv_id < 4 else None
        if back is not None:
            assert [(b.role, b.text) for b in back] == own
            assert "".join(b.text for b in back if b.loss) == "".join(t for role, t in own if role == "assistant")
        masked = "".join(r.formatted[s.start : s.end] for s in r.loss_spans)
        assert masked.replace("\\l", "<").replace("\\b", "\\") == "".join(t for role, t in own if role == "assistant")
        assert r.n_turns == len(own) == r.formatted.count("</turn>\n")


def test_chat_parts(spark):
    part = lambda kind, **more: {"kind": kind, "text": None, "ref": None, "width": None, "height": None, "seconds": None, "pages": None} | more
    parts = [
        [part("text", text="see "), part("image", ref="i.png", width=28, height=15), part("text", text=" and <b>"), part("audio", ref="a.wav", seconds=2.1)],
        [part("document", ref="d.pdf", pages=3), part("image"), part("hologram", text="x")], None,
    ]
    table = spark.createDataFrame([(1, i, "user", p) for i, p in enumerate(parts)], f"conv_id int, turn int, role string, parts {chat.PARTS}")
    (r,) = chat.format_chats(table).collect()
    assert r.formatted == "<turn>user\nsee <image 0> and \\lb><audio 1></turn>\n<turn>user\n<document 2><image 3>x</turn>\n<turn>user\n</turn>\n"
    assert [(a.number, a.kind, a.ref, a.tokens) for a in r.attachments] == [(0, "image", "i.png", 4), (1, "audio", "a.wav", 53), (2, "document", "d.pdf", 768), (3, "image", None, 1)]
    assert r.attachment_tokens == 826 and r.loss_spans == []


def test_chat_awkward(awkward, empty):
    turns = lambda t: t.select("*", F.col("doc_id").alias("conv_id"), F.lit(None).cast("int").alias("turn"), F.lit(None).cast("string").alias("role"), chat.text_parts(F.col("text")).alias("parts"))
    found = chat.format_chats(turns(awkward)).collect()
    assert sum(r.n_turns for r in found) == awkward.count() and None in [r.conv_id for r in found]
    assert chat.format_chats(turns(empty)).count() == 0


# ---- token counts


def test_separators_in_tiny_blocks(spark, monkeypatch):
    monkeypatch.setattr(separators, "GROUP", 3)
    draw = random.Random(9)
    files, expected = [], {}
    for f in range(4):
        ids = [draw.choice([7, 1, 2, 3]) if f else draw.choice([1, 2]) for _ in range(draw.randint(1, 90))]
        raw, at, block = np.array(ids, "<u2").tobytes(), 0, 0
        while at < len(raw):
            step = 2 * draw.randint(0, 6)
            files.append((f, block, bytearray(raw[at : at + step])))
            at, block = at + step, block + 1
        docs, start = [], 0
        for i, x in enumerate(ids):
            if x == 7:
                docs.append((start, i - start, True))
                start = i + 1
        expected[f] = docs + ([(start, len(ids) - start, False)] if start < len(ids) else [])
    table = spark.createDataFrame(files + [(9, 0, None)], "file bigint, block bigint, payload binary").repartition(5)
    found = separators.scan_separators(table, Scratch(spark, "t"), end=7).collect()
    assert {(r.file, r.ordinal): (r.start, r.n_tokens, r.ended) for r in found} == {(f, k): d for f, own in expected.items() for k, d in enumerate(own)}
    assert len(found) == sum(map(len, expected.values()))


def test_token_counts(spark, awkward, empty, monkeypatch, tmp_path):
    monkeypatch.setattr(separators, "BLOCK_BYTES", 64)
    encode = separators._encoding(separators.VOCABULARY).encode_ordinary
    docs = awkward.union(awkward.withColumn("text", F.lit("<|endoftext|> is text")))
    found = separators.count_tokens(docs).collect()
    assert sorted(r.n_tokens for r in found) == sorted(len(encode(r.text or "")) for r in docs.collect())
    assert separators.count_tokens(empty).count() == 0
    ids = [5, 50256, 50256, 6, 7, 50256, 8]
    (tmp_path / "a.bin").write_bytes(np.array(ids, "<u2").tobytes())
    blocks = separators.read_token_files(spark, str(tmp_path), block_bytes=4)
    assert sorted(r.n_tokens for r in separators.scan_separators(blocks, Scratch(spark, "t")).collect()) == [0, 1, 1, 2]


# ---- quality


def _labelled(spark, n=400):
    draw = random.Random(6)
    rows, labels = [], []
    for i in range(n):
        good = i % 4 != 0
        words = ["".join(draw.choices("abcdefgh", k=draw.randint(2, 8))) for _ in range(draw.randint(5, 300))]
        text = " ".join(w if good else draw.choice([w.upper() + "!!", w + "$$$"]) for w in words)
        rows.append((i, text))
        labels.append((i, int(good), 0))
    return spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_quality(spark, awkward, empty):
    docs, labels = _labelled(spark)
    model = quality.train(docs, labels)
    truth = {r.doc_id: r.quality for r in labels.collect()}
    found = quality.score_quality(docs, model).collect()
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.3)
    held = [r for r in found if r.held_out]
    assert len(held) > 40 and sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    again = quality.score_quality(docs, quality.train(docs.repartition(7), labels)).collect()
    assert {r.doc_id: r.score for r in again} == {r.doc_id: r.score for r in found}
    # held-out labels have no part in the model
    flipped = labels.withColumn("quality", F.when(quality.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    other = quality.train(docs, flipped)
    assert all(np.array_equal(other.weights[k], model.weights[k]) for k in model.weights)
    odd = quality.score_quality(awkward, model).collect()
    assert len(odd) == awkward.count() and all(0 <= r.score <= 1 for r in odd)
    assert quality.keep_good(docs, model).columns == docs.columns
    assert quality.score_quality(empty, model).count() == 0 and quality.keep_good(empty, model).count() == 0
    nothing = quality.train(empty, labels)
    assert quality.score_quality(awkward, nothing).count() == awkward.count()


def test_quality_gradients():
    """The written derivatives are those of the loss."""
    draw = np.random.default_rng(0)
    x, bounds, y = draw.normal(size=(9, quality.FEATURES)), np.array([0, 2, 5, 9]), np.array([1.0, 0.0, 1.0])
    weight = np.array([0.75, 1.5, 0.75])
    model = quality.Model._start(np.zeros(quality.FEATURES), np.ones(quality.FEATURES))

    def loss():
        p = quality._sigmoid(model._forward(x, bounds)[-1])
        return float(-(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / len(y))

    for name, g in model._gradients(x, bounds, y, weight).items():
        w = model.weights[name]
        at = tuple(0 for _ in w.shape)
        keep, step = w[at].copy(), 1e-6
        w[at] = keep + step
        up = loss()
        w[at] = keep - step
        down = loss()
        w[at] = keep
        assert math.isclose((up - down) / (2 * step), float(np.asarray(g)[at]), rel_tol=1e-3, abs_tol=1e-7), name


# ---- licences


def test_licenses(spark, awkward, empty):
    mit, gpl, words = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3.", "plain words of the file"
    files = [
        ("LICENSE", mit), ("a/x.txt", words), ("a/b/COPYING", gpl), ("a/b/LICENSE.md", f"{mit}\n{mit}"), ("a/b/y.txt", words), ("a/b/c/d/z.txt", f"# {words}\n{words}"),
        ("a/b/c/own.txt", f"{words}\n# Licensed under the Apache License, Version 2.0.\n{words}"), ("top.txt", None), (None, words), (None, mit), ("e/LICENSE", words), ("e/f.txt", ""),
        ("e/g.txt", "the license is under version of the version"),
    ]
    found = licenses.scan_licenses(spark.createDataFrame(files, "path string, text string")).collect()
    got = {r.path: (r.licenses, r.origin, r.distance) for r in found if r.path}
    assert got["a/x.txt"] == (["MIT"], "inherited", 1) and got["top.txt"] == (["MIT"], "inherited", 0)
    assert got["a/b/y.txt"] == (["GPL-3.0", "MIT"], "inherited", 0) and got["a/b/c/d/z.txt"] == (["GPL-3.0", "MIT"], "inherited", 2)
    assert got["a/b/c/own.txt"] == (["Apache-2.0"], "own", None) and got["LICENSE"] == (["MIT"], "own", None)
    assert got["e/f.txt"] == (["MIT"], "inherited", 1) and got["e/LICENSE"][1] == "inherited" and got["e/g.txt"][1] == "inherited"
    assert sorted(r.origin for r in found if r.path is None) == ["none", "own"]
    assert len(found) == len(files)
    paths = lambda t: licenses.scan_licenses(t.withColumn("path", F.col("source")))
    assert paths(awkward).count() == awkward.count() and paths(empty).count() == 0


def test_all_licenses_of_a_file(spark):
    """A file has the licences of all its segments, and neighbours of a licence are not taken for it."""
    apache, mit = "Licensed under the Apache License, Version 2.0.", "Released under the MIT License."
    gnu = "This work is licensed under the GNU {}General Public License, version {}."
    one = {
        "Licensed under CC BY 4.0.": "CC-BY-4.0", "Licensed under CC BY-SA 4.0.": "CC-BY-SA-4.0", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
        gnu.format("", 2): "GPL-2.0", gnu.format("", 3): "GPL-3.0", gnu.format("Lesser ", 3): "LGPL-3.0", gnu.format("Lesser ", 2.1): "LGPL-2.1",
        "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted": "ISC",
    }
    files = [("d/LICENSE", f"{apache}\nwords between\n{mit}"), ("d/x.txt", "plain words"), ("d/e/own.txt", f"{mit}\nplain\n{gnu.format('', 2)}")]
    files += [(f"o/{i}.txt", f"plain words\nof the file\n{line}\nand other words {i}") for i, line in enumerate(one)] + [(f"w/{i}", f"plain words of file {i}\nmore of the words") for i in range(40)]
    table = spark.createDataFrame(files, "path string, text string")
    got = {r.path: r.licenses for r in licenses.scan_licenses(table).collect()}
    assert got["d/LICENSE"] == got["d/x.txt"] == ["Apache-2.0", "MIT"] and got["d/e/own.txt"] == ["GPL-2.0", "MIT"]
    assert [got[f"o/{i}.txt"] for i in range(len(one))] == [[name] for name in one.values()]
    mine = {r.path: r.licenses for r in licenses.scan_licenses(table, templates=[("House", "words between")]).collect()}
    assert mine["d/LICENSE"] == mine["d/x.txt"] == ["House"] and mine["o/0.txt"] == []


# ---- vectors


def _vectors():
    draw = np.random.default_rng(8)
    rows = []
    for label in (0, 1, None):
        centre = draw.normal(size=16)
        for _ in range(160):
            rows.append((len(rows), (centre + draw.normal(size=16) * draw.choice([0.12, 0.3, 1.5])).tolist(), label))
    rows += [(len(rows) + i, rows[0][1], 0) for i in range(30)]  # copies
    n = len(rows)
    rows += [(n, None, 0), (n + 1, [0.0] * 16, 0), (n + 2, [float("nan")] * 16, 0), (n + 3, [None] * 16, 0), (n + 4, [float("inf")] + [1.0] * 15, 0), (n + 5, [], 0)]
    rows += [(n + 6, [1.0, 2.0], 0), (n + 7, [2.0, 4.0], 0), (None, rows[0][1], 0), (3, rows[3][1], 0), (n + 8, [1e200] * 16, 1), (n + 9, [1e-200] * 16, 1)]
    return rows


def _cosine_groups(rows, least):
    """(links of every row, its group) by all pairs."""
    sound = [v is not None and lab is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v, lab in rows]
    units = [np.array(v) / max(map(abs, v)) if s else None for (_, v, _), s in zip(rows, sound)]
    units = [u / np.linalg.norm(u) if u is not None else None for u in units]
    links, groups = [0] * len(rows), plain.Groups(len(rows))
    for i in range(len(rows)):
        for j in range(i):
            if sound[i] and sound[j] and rows[i][2] == rows[j][2] and len(units[i]) == len(units[j]) and float(units[i] @ units[j]) >= least:
                links[i] += 1
                links[j] += 1
                groups.join(i, j)
    return links, [groups.root(i) for i in range(len(rows))]


@pytest.mark.parametrize(("interval", "leaf"), [(2048, 256), (10, 3)])
def test_embedding_links(spark, monkeypatch, interval, leaf):
    monkeypatch.setattr(grid_join, "INTERVAL", interval)
    monkeypatch.setattr(grid_join, "LEAF", leaf)
    rows = _vectors()
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").withColumn("node", F.lit(1))
    found = grid_join.embedding_links(table).collect()
    links, groups = _cosine_groups(rows, 0.93)
    smallest = {}
    for (i, _, _), g in zip(rows, groups):
        if i is not None:
            smallest[g] = min(smallest.get(g, i), i)
    expected = sorted(((-1 if i is None else i), n, smallest.get(g), i is not None and smallest[g] == i) for (i, _, _), n, g in zip(rows, links, groups))
    assert sorted((-1 if r.vec_id is None else r.vec_id, r.n_links, r.component_id, r.kept) for r in found) == expected
    assert max(links) > 60
    assert grid_join.embedding_links(table.filter("false")).count() == 0


# ---- pages

PAGE = """<!DOCTYPE html><html><head><title>t</title><script>var t="</p>";</script></head><body><nav>menu</nav><div class="cookie-notice">ok?</div>
<div class="ad">buy</div><article><h1>Head &amp; line</h1><p><b>One  <i>two</i><br>three<p>fo&eacute;ur &lt;p&gt;</p><!-- c --><ul><li>a<li>b</ul>
<aside>side</aside><form><p>mail?</p></form><div>tail <p>inner</p> end</div><section id="comments"><p>nice!</p></section></article><footer>&copy;</footer></body></html>"""
MAIN = "Head & line\nOne two three\nfoéur <p>\na\nb\ntail\ninner\nend"


def test_pages(spark):
    rows = [(1, "http://a.b/x", PAGE), (2, None, PAGE), (2, "nonsense", None), (3, "http://a.b/y", ""), (4, "http://a.b/", "just text &amp; more"), (None, "http://a.b/", "<p>x")]
    # pages without an article: what many pages of the host share is template, and nothing else goes
    rows += [(10 + i, f"https://T.org:80/{i}", f"<body><div>Site name</div><p>own text {i}</p><div><p>again</p></div><p>{'same' if i < 2 else i}</p></body>") for i in range(9)]
    rows += [(30 + i, f"https://u.org/{i}", "<article><p>a copied article</p></article>") for i in range(9)]
    found = site_templates.extract_main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("row", F.lit(1)))
    got = [(r.page_id, r.url, r.text) for r in found.collect()]
    assert len(got) == len(rows)
    text = {(i, u): t for i, u, t in got}
    assert text[1, "http://a.b/x"] == text[2, None] == MAIN
    assert text[2, "nonsense"] == text[3, "http://a.b/y"] == "" and text[4, "http://a.b/"] == "just text & more" and text[None, "http://a.b/"] == "x"
    for i in range(9):
        assert text[10 + i, f"https://T.org:80/{i}"] == f"own text {i}\n{'same' if i < 2 else i}"
        assert text[30 + i, f"https://u.org/{i}"] == "a copied article"
    assert all(r.n_chars == len(r.text) for r in found.collect())
    assert site_templates.extract_main_text(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


def _main_texts(spark, pages):
    rows = [(i, url, source) for i, (url, source) in enumerate(pages)]
    return [r.text for r in site_templates.extract_main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).orderBy("page_id").collect()]


@pytest.mark.parametrize("bound", [site_templates.BROADCAST_BYTES, 0])
def test_pages_whole_page_counts(spark, monkeypatch, bound):
    """Subtrees count wherever they stand, and templates go before the article rule."""
    monkeypatch.setattr(site_templates, "BROADCAST_BYTES", bound)
    # teasers in articles recur in changing pairs; the text of the page stands outside of them
    teasers = [f"<article><div>teaser {k}</div></article>" for k in range(3)]
    pages = [("http://a.b/", f"<body>{teasers[i % 3]}{teasers[(i + 1 + i // 3 % 2) % 3]}<div><p>own text {i}</p></div></body>") for i in range(12)]
    assert _main_texts(spark, pages) == [f"own text {i}" for i in range(12)]
    # a box outside of articles, and one that marks itself, are template on pages that have no article
    for box in ("<div>Site name</div>", "<div class='menu'>Site name</div>"):
        pages = [("http://a.b/", f"{box}<article><p>text {i}</p></article>") for i in range(8)] + [("http://a.b/", f"<div>Site name</div><p>plain {i}</p>") for i in range(2)]
        assert _main_texts(spark, pages) == [*[f"text {i}" for i in range(8)], "plain 0", "plain 1"]


def test_pages_many_pages_and_copies(spark):
    # a box on a small part of a large host's pages is template, a line on a few of them is not
    pages = [("http://a.b/", f"{'<div>box</div>' if i < 25 else ''}{'<p>said again</p>' if 25 <= i < 35 else ''}<p>text {i}</p>") for i in range(120)]
    assert _main_texts(spark, pages) == [f"said again\ntext {i}" if 25 <= i < 35 else f"text {i}" for i in range(120)]
    # copies of a page, with a changing advert or without an article, are no template of their own
    copies = [("http://c.d/", f"<div class='ad'>ad {i}</div><div>Site</div><article><div>copied</div></article>") for i in range(6)]
    copies += [("http://e.f/", f"<nav>{i}</nav><div class='text'><section>copied as well</section></div>") for i in range(6)]
    copies += [("http://c.d/", f"<div>Site</div><article><div>own {i}</div></article>") for i in range(5)]
    assert _main_texts(spark, copies) == ["copied"] * 6 + ["copied as well"] * 6 + [f"own {i}" for i in range(5)]


def test_pages_names():
    """Names hide by whole names and customary compounds, and never what holds the main text."""
    shown = lambda source: [text for text, _, _ in site_templates._Page(source).result() if text]
    for name in ("layout no-sidebar", "has-sidebar", "with-menu", "page-notification-bar-off", "sidebar", "content sidebar-left"):
        assert shown(f"<div class='{name}'><p>a</p><article><p>b</p></article></div>")[-1] == "b", name
        assert shown(f"<body class='{name}'><div id='{name}'><main>b</main></div></body>") == ["b"], name
    for name in ("no-sidebar", "has-menu", "related-work", "page-notification-bar-off", "skip-logic", "banner-history"):
        assert shown(f"<div class='{name}'>b</div>") == ["b"], name
    for name in ("ad", "ad-slot", "cookie-notice", "left_sidebar", "sidebar-left", "related-posts", "nav-links", "share-buttons", "ad_slot_3", "x footer"):
        assert shown(f"<div class='{name}'>a</div><article><div class='{name}'>a</div>b</article>") == ["b"], name
    assert shown("<article><p class='notice'>a</p><div class='alert'>b</div><div class='related-work'>c</div><p class='comment'>d</p><p class='ad'>e</p></article>") == ["a", "b", "c", "d"]
    assert shown("<nav><article>a</article></nav><aside><p>a</p></aside><div hidden><article>a</article></div>b <span class='share'>a</span> c") == ["b c"]


def test_pages_never_break():
    draw = random.Random(3)
    bits = ["<p>", "</p>", "<div class='ad'", "<", ">", "</", "<script>", "</script", "text ", "&amp", "<!--", "-->", "<b>", "</b>", "<li>", "<td>", "é", "\x00", "<article>", "</article>", '"', "<a href=\"x>y\">"]
    for _ in range(400):
        site_templates._Page("".join(draw.choices(bits, k=40))).result()
