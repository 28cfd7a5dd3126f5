"""Quality rules and the perplexity model against plain Python."""

import math
import random
from collections import Counter, defaultdict

import plain
import pytest

from ledgerloom.llm import perplexity, queries


def _plain_figures(text):
    words = plain.WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if plain.WORD.search(x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    return len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def _plain_model(words):
    """``words``: word -> count. Logarithm of the probability of every 5-gram of characters."""
    counts = {5: Counter()}
    for w, n in words.items():
        marked = "    " + w + "\n"
        for i in range(len(w) + 1):
            counts[5][marked[i : i + 5]] += n
    for k in (4, 3, 2, 1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    p = {"": 1 / len(counts[1])}
    for k in range(1, 6):
        n = Counter(counts[k].values())
        y = n[1] / (n[1] + 2 * n[2]) if n[1] + 2 * n[2] else 0
        d = [0, *[min(i, max(0, i - (i + 1) * y * n[i + 1] / n[i])) if n[i] else 0 for i in (1, 2, 3)]]
        total, given = Counter(), Counter()
        for g, c in counts[k].items():
            total[g[:-1]] += c
            given[g[:-1]] += d[min(c, 3)]
        p = {g: (max(c - d[min(c, 3)], 0) + given[g[:-1]] * p[g[1:]]) / total[g[:-1]] for g, c in counts[k].items()}
    return {g: math.log(x) for g, x in p.items()}


def _plain_perplexities(rows):
    """``rows``: (id, lang, text) -> id: perplexity."""
    of = defaultdict(Counter)
    for _, lang, text in rows:
        of[lang or ""].update(plain.WORD.findall(text or ""))
    models = {lang: _plain_model(words) for lang, words in of.items() if words}
    found = {}
    for i, lang, text in rows:
        words = plain.WORD.findall(text or "")
        grams = [("    " + w + "\n")[k : k + 5] for w in words for k in range(len(w) + 1)]
        found[i] = math.exp(-sum(models[lang or ""][g] for g in grams) / len(grams)) if grams else None
    return found


def _middle(values):
    ordered = sorted(math.floor(v * perplexity.BINS) for v in values)
    n = len(ordered)
    return ((ordered[(n - 1) // 2] + ordered[n // 2]) / 2 + 0.5) / perplexity.BINS if n else 0.0


def _plain_kept(rows, found):
    """Bands by language around the median; equal texts count once."""
    passes, by_lang = {}, defaultdict(dict)
    for i, lang, text in rows:
        n_words, _, _, _, repeated = _plain_figures(text)
        passes[i] = n_words >= 10 and 100 * repeated <= 20 * n_words
        if passes[i]:
            by_lang[lang or ""][tuple(plain.WORD.findall(text))] = (math.log(found[i]), n_words)
    bands = {}
    for lang, texts in by_lang.items():
        centre = _middle([x for x, _ in texts.values()])
        off = [(x - centre) * math.sqrt(n / (n + 200)) for x, n in texts.values()]
        bands[lang] = centre, [max(0.05, 5 * _middle(side)) for side in ([x for x in off if x >= 0], [-x for x in off if x < 0])]
    kept = {}
    for i, lang, text in rows:
        kept[i] = False
        if passes[i]:
            centre, (high, low) = bands[lang or ""]
            n = len(plain.WORD.findall(text))
            off = (math.log(found[i]) - centre) * math.sqrt(n / (n + 200))
            kept[i] = None if min(abs(off - high), abs(off + low)) < 1e-6 else -low <= off <= high
    return kept


def _check(rows, got):
    expected = _plain_perplexities(rows)
    kept = _plain_kept(rows, expected)
    got = {r.doc_id: r for r in got}
    assert set(got) == {i for i, _, _ in rows}
    for i, _, text in rows:
        r = got[i]
        figures = _plain_figures(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == figures
        assert r.base_failed == (figures[0] < 10 or 100 * figures[4] > 20 * figures[0])
        assert (r.perplexity is None) == (expected[i] is None) and (r.perplexity is None or abs(math.log(r.perplexity / expected[i])) < 1e-6)
        assert kept[i] is None or r.kept == kept[i]
    return got


def test_registered_rules(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.lang, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = _check(rows, queries.op13_quality_rules(spark, sf).collect())
    assert any(r.base_failed for r in got.values()) and sum(r.kept for r in got.values()) > 0.8 * len(got)


@pytest.mark.parametrize("block_words", [50, 1 << 20])
def test_rules_plain(spark, monkeypatch, block_words):
    """Blocks, shards and partitions of any size give the same model; a gibberish and a copied text."""
    rng = random.Random(5)
    monkeypatch.setattr(perplexity, "BLOCK_WORDS", block_words)
    monkeypatch.setattr(perplexity, "SHARD", 64)
    stems = ["an", "be", "lo", "ti", "ré", "ß", "漢字", "😀", "x#", "&"]
    word = lambda: "".join(rng.choice(stems) for _ in range(rng.choice((1, 2, 2, 3))))
    texts = ["\n".join(" ".join(word() for _ in range(rng.choice((0, 3, 9)))) for _ in range(rng.choice((1, 4, 12)))) for _ in range(80)]
    texts += [None, "", " \t\n\x0b", "one", "a b c d e " * 9, texts[3], "q" * 3000, " ".join(chr(rng.randrange(0x3B1, 0x3C9)) * 3 for _ in range(60)), "l\nl \nl\n\n \nl"]
    texts += [texts[7]] * 40
    rows = [(i, rng.choice(["en", "de", None]), t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([(*r, 1, "b") for r in rows], "doc_id long, lang string, text string, shard int, block string").repartition(7)
    _check(rows, perplexity.rate_documents(docs).collect())


def test_rules_awkward(spark, awkward, empty):
    found = perplexity.rate_documents(awkward.withColumn("kept", awkward.row)).collect()
    assert sorted((r.n_words, r.base_failed) for r in found) == sorted((len(plain.WORD.findall(r.text or "")), _plain_figures(r.text)[0] < 10 or _plain_figures(r.text)[4] > 0) for r in awkward.collect())
    assert sum(r.doc_id is None for r in found) == 1
    assert perplexity.rate_documents(empty).collect() == []
    assert perplexity.rate_documents(awkward.withColumn("doc_id", awkward.text)).schema["doc_id"].dataType.typeName() == "string"


def test_rules_tell_gibberish(spark):
    """Noise among prose of its language falls out above, a text of the commonest words below."""
    rng = random.Random(2)
    vowels, rest = "aeiou", "lmnrst"
    prose = lambda n: " ".join("".join(rng.choice(rest) + rng.choice(vowels) for _ in range(rng.choice((1, 2, 3)))) for _ in range(n))
    rows = [(i, "xx", prose(rng.choice((40, 200, 400)))) for i in range(300)]
    rows.append((1000, "xx", " ".join("".join(rng.choice("bcdfghjkqvwxyz") for _ in range(6)) for _ in range(200))))
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    kept = {r.doc_id: r.kept for r in perplexity.rate_documents(docs).collect()}
    assert not kept.pop(1000) and sum(kept.values()) >= 297
