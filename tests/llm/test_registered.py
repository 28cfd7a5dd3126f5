"""The registered queries over the smallest tables: against SQL where there is a statement, else against plain Python."""

import html
import re

import numpy as np
import plain
import pytest
from compare import compare, connect

import __spark_entry__ as entry
import corpus_pipeline
from ledgerloom.llm import queries, separators

SF = "/root/testdata/sf0.001"


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet").collect()


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in table(spark, "documents")}


def test_registered():
    assert [f"op{n}_" for n in range(1, 14)] == sorted((re.match(r"op\d+_", n)[0] for n in queries.QUERIES), key=lambda x: int(x[2:-1]))
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries()) and "pipeline" not in entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_against_sql(spark, name):
    assert compare(queries.QUERIES[name](spark, SF), connect(SF), queries.SQL[name]) == []


def test_mixing(spark, texts):
    rows = queries.op1_mixing(spark, SF).collect()
    assert {r.doc_id: r["size"] for r in rows} == {i: len(plain.words(t)) for i, t in texts.items()}
    share = sum({r.source: r.target for r in rows}.values()) / sum(r["size"] for r in rows)
    assert abs(share - 1.5) < 1e-9 and all(r.taken in (0, r["size"], 2 * r["size"]) for r in rows)


def test_token_counts(spark, texts):
    encode = separators._encoding(separators.VOCABULARY).encode_ordinary
    assert {r.doc_id: r.n_tokens for r in queries.op3_separators(spark, SF).collect()} == {i: len(encode(t or "")) for i, t in texts.items()}


def test_ngram_join(spark, texts):
    ids = sorted(texts)
    groups = plain.components([texts[i] for i in ids], 4, 85)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op4_ngram_join(spark, SF).collect()}
    assert got == {i: (len(plain.shingles(texts[i], 4)), ids[g]) for i, g in zip(ids, groups)}


def test_decontamination(spark, texts):
    join = lambda t: " ".join(plain.WORD.findall(t or ""))
    items = {r.item_id: join(r.text) for r in table(spark, "benchmark")}
    exact = {(i, k) for i, t in texts.items() for k, item in items.items() if item in join(t)}
    rows = queries.op6_decontaminate(spark, SF).collect()
    assert exact <= {(r.doc_id, r.item_id) for r in rows}
    for r in rows:  # whatever else is found shares the runs of words it says
        assert min(r.question_overlap, r.answer_overlap) >= 0.8


def test_quality(spark):
    labels = {r.doc_id: r.quality for r in table(spark, "labels")}
    held = [r for r in queries.op7_quality(spark, SF).collect() if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in held) >= 0.9 * len(held)


def test_vectors(spark):
    rows = table(spark, "embeddings")
    unit = np.array([r.embedding for r in rows], float)
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    label = np.array([r.label for r in rows])
    linked = (unit @ unit.T >= 0.93) & (label[:, None] == label[None, :])
    np.fill_diagonal(linked, False)
    groups = plain.Groups(len(rows))
    for i, j in zip(*np.nonzero(linked)):
        groups.join(int(i), int(j))
    ids, smallest = [r.vec_id for r in rows], {}
    for i, v in enumerate(ids):
        smallest[groups.root(i)] = min(v, smallest.get(groups.root(i), v))
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in queries.op9_grid_join(spark, SF).collect()}
    assert got == {v: (int(linked[i].sum()), smallest[groups.root(i)], smallest[groups.root(i)] == v) for i, v in enumerate(ids)}


def test_pages(spark):
    source = {r.page_id: r.html for r in table(spark, "pages")}
    for r in queries.op10_site_templates(spark, SF).collect():
        article = re.search(r"<article>(.*?)</article>", source[r.page_id], re.S)[1].replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_pipeline_stages(spark, texts):
    """Every stage against plain Python over what its predecessor kept."""
    given = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r.quality for r in table(spark, "labels")}
    kept, now = {}, given
    for name, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, SF)
        rows = now.collect()
        kept[name] = {r.doc_id: r for r in rows}
        assert len(rows) == len(kept[name]) and (name.startswith("mixing") or now.columns == given.columns)
        now = spark.createDataFrame(rows, now.schema)
    good, deduped, single, clean, mixed = kept.values()
    assert sum((i in good) == (q == 1) for i, q in labels.items()) >= 0.95 * len(labels)
    assert all(r.text == texts[i] for i, r in good.items())
    from test_text_operators import _plain_line_dedup

    expected = _plain_line_dedup(sorted((i, r.text) for i, r in good.items()), 50)
    assert {i: r.text for i, r in deduped.items()} == {i: t for i, t in expected.items() if t == good[i].text or t.strip()}
    assert all(r.n_chars == len(r.text) for r in deduped.values())
    ids = sorted(deduped)
    groups = plain.components([deduped[i].text for i in ids], 5, 80)
    assert sorted(single) == [i for k, i in enumerate(ids) if groups[k] == k]
    items = [" ".join(plain.WORD.findall(r.text)) for r in table(spark, "benchmark")]
    leaked = {i for i, r in single.items() if any(item in " ".join(plain.WORD.findall(r.text)) for item in items)}
    assert leaked and set(clean) <= set(single) - leaked and len(single) - len(leaked) - len(clean) <= 1
    assert set(mixed) <= set(clean) and all(r.copies in (1, 2) for r in mixed.values())
    words = sum(len(plain.words(r.text)) for r in clean.values())
    assert abs(sum({r.source: r.target for r in mixed.values()}.values()) / words - 1.5) < 0.2
