"""N-gram join, line deduplication, decontamination and the text kit against plain versions."""

import random
import tracemalloc

import numpy as np
import plain
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from ledgerloom.llm import decontaminate, line_dedup, ngram_join, textkit
from ledgerloom.llm.common import Scratch, connected_components


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB \t\n\x0b\x1cé世", max_size=40)), max_size=6), st.integers(1, 5))
def test_words_and_shingles(texts, k):
    array = pa.array(texts, pa.string())
    found = textkit.Words(array)
    split = found.arrow().to_pylist()
    assert [split[a:b] for a, b in zip(found.bounds[:-1], found.bounds[1:])] == [plain.words(t) for t in texts]
    assert [len(s) for _, s in textkit.shingle_sets(array, k)] == [len(plain.shingles(t, k)) for t in texts]


def _near_copies(seed=3):
    """Bases with edited copies, a passage many share, and short texts."""
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = " ".join(draw.choices(vocabulary, k=40))
    texts = [None, "", "   ", "w1", "W1", "w1 w2", "w1 w2 w3 w4", "w1 w2 w3 w4"]
    for _ in range(12):
        base = draw.choices(vocabulary, k=draw.randint(60, 160))
        for _ in range(draw.randint(1, 6)):
            copy = list(base)
            for _ in range(draw.randint(0, 2)):
                copy[draw.randrange(len(copy))] = draw.choice(vocabulary)
            texts.append(" ".join(copy))
    for _ in range(60):  # more than the limit of common tokens
        texts.append(passage + " " + " ".join(draw.choices(vocabulary, k=draw.randint(2, 60))))
    base = draw.choices(vocabulary, k=90)
    for i in range(50):  # one large group of near copies, some beyond the threshold
        copy = list(base)
        for _ in range(i % 4):
            copy[draw.randrange(len(copy))] = f"own{i}"
        texts.append(" ".join(copy))
    draw.shuffle(texts)
    return texts


@pytest.mark.parametrize(("k", "percent"), [(4, 85), (5, 80)])
def test_ngram_components(spark, k, percent):
    texts = _near_copies()
    docs = spark.createDataFrame([(i * 10, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    found = {r.doc_id: r for r in ngram_join.ngram_components(docs, words=k, percent=percent).collect()}
    assert len(found) == len(texts)
    expected = plain.components(texts, k, percent)
    assert len(set(expected)) < len(texts) - 30
    for i, t in enumerate(texts):
        assert found[i * 10].n_shingles == len(plain.shingles(t, k))
        assert found[i * 10].component_id == expected[i] * 10


def test_ngram_awkward(spark, awkward, empty):
    rows = ngram_join.ngram_components(awkward).collect()
    assert len(rows) == awkward.count()
    assert [r.component_id for r in rows if r.n_shingles == 1 and r.doc_id is None] == [None]
    kept = ngram_join.drop_near_duplicates(awkward)
    assert kept.columns == awkward.columns
    # "a b c d" comes twice; texts without words all stay
    assert sorted(r.row for r in kept.collect()) == [0, 1, 2, 3, 4, 6, 7, 8, 9]
    assert ngram_join.drop_near_duplicates(empty).count() == 0
    assert ngram_join.ngram_components(empty).count() == 0


def test_components_of_paths(spark):
    draw = random.Random(5)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(draw.randint(200, 260), draw.randint(200, 260)) for _ in range(40)]
    groups = plain.Groups(300)
    for u, v in edges:
        groups.join(u, v)
    found = connected_components(spark.createDataFrame(edges, "u bigint, v bigint"), Scratch(spark, "t"), "c").collect()
    assert {r.node: r.root for r in found} == {n: groups.root(n) for e in edges for n in e if e[0] != e[1] or groups.up.count(n) > 1}


def _plain_line_dedup(docs, least):
    """Documents in id order: every pair of equal lines is grown both ways, and runs of enough words go where they come later."""
    places, out = {}, {}
    full = {}
    for i, text in docs:
        lines = text.split("\n")
        full[i] = [(k, line, len(plain.WORD.findall(line))) for k, line in enumerate(lines) if plain.WORD.search(line)]
        gone = set()
        for at, (_, line, _) in enumerate(full[i]):
            for j, other in places.get(line, []):
                mine, theirs = full[i], full[j]
                if at and other and mine[at - 1][1] == theirs[other - 1][1]:
                    continue  # not the first line of the match
                n = 0
                while at + n < len(mine) and other + n < len(theirs) and mine[at + n][1] == theirs[other + n][1]:
                    n += 1
                if sum(words for _, _, words in mine[at : at + n]) >= least:
                    gone |= set(range(mine[at][0], mine[at + n - 1][0] + 1))
            places.setdefault(line, []).append((i, at))
        out[i] = "\n".join(line for k, line in enumerate(lines) if k not in gone)
    return out


def test_line_dedup(spark):
    draw = random.Random(11)
    lines = [" ".join(f"w{draw.randint(0, 30)}" for _ in range(draw.choice([1, 2, 3, 8]))) for _ in range(14)] + ["", " "]
    docs = [(i, "\n".join(draw.choices(lines, k=draw.randint(0, 14)))) for i in range(80)]
    found = line_dedup.drop_repeated_lines(spark.createDataFrame(docs, "doc_id bigint, text string"), min_words=12).collect()
    expected = _plain_line_dedup(docs, 12)
    assert {r.doc_id: r.text for r in found} == expected
    assert sum(r.n_removed for r in found) > 50


@pytest.mark.parametrize("first, second", [("long short", "long short"), ("short long", "short long"), ("x short long short y", "short long short z")])
def test_line_dedup_extends_both_ways(spark, first, second):
    """A short line beside a long one goes with it, on either side, though no forward window holds it."""
    text = {"long": " ".join(f"w{i}" for i in range(60)), "short": "ten words that stand beside the long line of sixty"}
    docs = [(i, "\n".join(text.get(name, name) for name in row.split())) for i, row in enumerate([first, second, "short"])]
    found = line_dedup.drop_repeated_lines(spark.createDataFrame(docs, "doc_id bigint, text string"))
    assert {r.doc_id: r.text for r in found.collect()} == {0: docs[0][1], 1: "z" if "z" in second else "", 2: docs[2][1]}


def test_line_dedup_awkward(awkward, empty):
    found = line_dedup.drop_repeated_lines(awkward, min_words=4)
    assert found.count() == awkward.count() and set(awkward.columns) < set(found.columns)
    assert {r.row: r.text for r in found.collect()} == {
        r.row: "" if r.row == 5 else r.text for r in awkward.collect()  # the second "a b c d", another row of one id
    } or {r.row: r.text for r in found.collect()} == {r.row: r.text for r in awkward.collect()}  # or equal in id and text: one document
    assert line_dedup.drop_repeated_lines(empty).count() == 0


ITEMS = [(1, "Which river runs through the old town of Quarn? It is the Selmo."), (2, "name nine planets of the far system beyond the second sun"), (3, None), (4, " ")]


def test_decontaminate(spark):
    filler = " ".join(f"f{i}" for i in range(300))
    docs = [
        (1, f"{filler} Which river runs through the old town of Quarn? It is the Selmo. {filler}"),
        (2, "which RIVER runs through, the old town of quarn it is the selmo"),
        (3, f"{filler} Which river runs through the old town of Quarn? Nobody knows. {filler}"),  # no answer
        (4, filler), (5, None), (6, ""), (7, "name nine planets of the far system beyond the second sun"), (7, "It is the Selmo."),
    ]
    table, items = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(ITEMS, "item_id bigint, text string")
    found = decontaminate.find_leaks(table, items).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(1, 1), (2, 1), (7, 2)]
    assert sorted(r.doc_id for r in decontaminate.drop_contaminated(table, items).collect()) == [3, 4, 5, 6, 7]


def test_decontaminate_edited(spark):
    """One changed word in the question or the answer hides no item; another answer is no leak."""
    question, answer = "Which of the many rivers that rise in the northern hills runs through the old town of Quarn before the sea?".split(), "Only the Selmo does so today.".split()
    item, filler = question + answer, " ".join(f"f{i}" for i in range(100))
    edited = [[*item[:k], "other", *item[k + 1 :]] for k in range(len(item))] + [item[:8] + ["so", "called"] + item[8:]]
    docs = [(k, f"{filler} {' '.join(words)} {filler}") for k, words in enumerate(edited)]
    docs += [(100, f"{filler} {' '.join(question)} Nobody in the whole land knows. {filler} the Selmo does so only today"), (101, f"{filler} {' '.join(answer)} {filler}")]
    items = spark.createDataFrame([(1, " ".join(item))], "item_id bigint, text string")
    found = decontaminate.find_leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), items).collect()
    assert sorted(r.doc_id for r in found) == list(range(len(edited)))
    assert all(min(r.question_overlap, r.answer_overlap) >= 0.8 for r in found)


def test_retrieval_is_exact():
    """Pruning by open lists and block maxima loses no item at or above the threshold."""
    draw = random.Random(2)
    vocabulary = [f"t{i}" for i in range(60)]
    texts = [" ".join(draw.choices(vocabulary, k=draw.randint(4, 14))) for _ in range(30)]
    terms = decontaminate._terms(texts)
    df = {}
    for t in terms:
        for h in set(t.view("int64").tolist()):
            df[h] = df.get(h, 0) + 1
    index = decontaminate.Index.build(list(range(30)), texts, df, 30, sum(map(len, terms)) / 30)
    docs = [" ".join(draw.choices(vocabulary, k=draw.randint(0, 500))) for _ in range(12)] + texts[:5]
    words = textkit.Words(pa.array(docs), between=textkit.MARKS)
    hashes, bounds = words.hashes(), words.bounds
    got = {(d, p, i) for d, p, i, _ in index.retrieve(hashes, bounds)}
    expected = set()
    for d in range(len(docs)):
        own = hashes[bounds[d] : bounds[d + 1]]
        for p in range(max(1, -(-len(own) // index.half) - 1) if len(own) > index.half else 1):
            held = set(own[p * index.half : (p + 2) * index.half].tolist())
            rows = [r for r, h in enumerate(index.vocabulary.tolist()) if h in held]
            expected |= {(d, p, int(i)) for i in (index.impact[rows].sum(axis=0) >= decontaminate.THRESHOLD - 1e-9).nonzero()[0]}
    assert expected <= got and len(expected) > 20
    # a last half of its own is searched as a passage too
    assert all(index.impact[[r for r, h in enumerate(index.vocabulary.tolist()) if h in set(hashes[bounds[d] + p * index.half : min(bounds[d + 1], bounds[d] + (p + 2) * index.half)].tolist())], i].sum() >= decontaminate.THRESHOLD - 1e-9 for d, p, i in got)


def test_index_grows_with_the_items():
    """An index takes memory by the words of its items, not by terms times items."""
    texts = [" ".join(f"t{(i * 41 + k * k) % 60_000}" for k in range(40)) for i in range(6000)]
    terms = decontaminate._terms(texts)
    hashes, counts = np.unique(np.concatenate([np.unique(t) for t in terms]), return_counts=True)
    tracemalloc.start()
    index = decontaminate.Index.build(list(range(6000)), texts, dict(zip(hashes.view(np.int64).tolist(), counts.tolist())), 6000, 40.0)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    n = sum(map(len, terms))
    assert index.nbytes <= decontaminate.WORD_BYTES * n + decontaminate.ITEM_BYTES * 6000 and peak < 400 << 20
    # every item is found in itself
    for i in (0, 77, 5999):
        assert (i, 1.0) in [(k, round(score, 9)) for _, _, k, score in index.retrieve(terms[i], np.array([0, len(terms[i])]))]


def test_decontaminate_in_many_indexes(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "INDEX_BYTES", 4000)
    texts = [" ".join(f"w{i}x{k}" for k in range(12)) for i in range(20)]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id bigint, text string")
    assert len(list(decontaminate._indexes(items.withColumnRenamed("item_id", "item")))) > 3
    docs = spark.createDataFrame([(i, f"before {t} after") for i, t in enumerate(texts)], "doc_id bigint, text string")
    assert sorted((r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, items).collect()) == [(i, i) for i in range(20)]


def test_decontaminate_awkward(spark, awkward, empty):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert decontaminate.find_leaks(awkward, items).count() == 0
    assert decontaminate.drop_contaminated(awkward, items).count() == awkward.count()
    assert decontaminate.find_leaks(empty, items).count() == 0
    assert decontaminate.find_leaks(awkward, items.filter("false")).count() == 0
    assert decontaminate.drop_contaminated(awkward, items.filter("false")).count() == awkward.count()
