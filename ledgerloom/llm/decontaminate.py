"""Benchmark decontamination: BM25 retrieval of test items for every training passage, then verification.

The test items are the indexed side; every passage of every document is a query.
Scores are BM25 with each passage term counted once, as a share of the score the
item reaches with all its own terms, so one threshold fits items of any length.

Retrieval is exact, with block-max pruning in the manner of WAND: an item's
terms of least impact that together stay below the threshold cannot bring it in,
so only the lists of its other (essential) terms are opened. Items are kept in
blocks; for a passage, the largest impacts inside a block are summed, and a block
whose sum plus the most its closed lists can add stays below the threshold is
skipped. The items of the blocks left are scored in full.

An item that is retrieved is verified: 80 % of its words must lie in five-word runs
that the passage holds, and near these the passage must hold 80 % of the words of
its question, and of its answer (the item's last sentence). A run that crosses an
edit is lost, but not the words around it that lie in other runs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from . import textkit
from .common import Scratch

K1, B = 1.2, 0.75
# share of an item's own score that retrieves it
THRESHOLD = 0.6
# share of an item's score that its closed lists may add: fewer open lists to read, or tighter bounds
CLOSED = 0.35
# items per block of the index
BLOCK = 8
# words of a run; least share of the item's words in runs that the passage holds, and of the question's and the answer's words
SHINGLE, OVERLAP = 5, 0.8
# bytes of one built index, its vocabulary's bits aside; more items take further indexes, one after the other
INDEX_BYTES = 32 << 20
# bytes that a word of an item takes in an index at most: itself, its term, and an entry by term, by item, in an open list and in a block
WORD_BYTES = 8 + 16 + 4 * 12
# bytes that an item takes besides
ITEM_BYTES = 512
# least passage length; passages overlap by half, and a half holds any item of the index
PASSAGE = 128

_SENTENCE = re.compile(r"[.!?\n]\s+")
_KNOWN = 1 << 20


def question_and_answer(text: str) -> tuple[str, str]:
    """The item's last sentence is its answer; without one, its last fifth of words."""
    text = text.strip()
    ends = [m.end() for m in _SENTENCE.finditer(text)]
    if ends:
        return text[: ends[-1]], text[ends[-1] :]
    words = text.split()
    cut = len(words) - max(1, len(words) // 5)
    return " ".join(words[:cut]), " ".join(words[cut:])


def overlaps(words: np.ndarray, asked: int, held: np.ndarray) -> tuple[float, float, float]:
    """Shares of an item's words in runs that ``held`` holds, and of its question's (``asked`` words) and answer's words near these runs."""
    size = min(SHINGLE, len(words))
    own, runs = textkit.shingle_hashes(words, size), textkit.shingle_hashes(held, size)
    order = np.argsort(runs, kind="stable")
    low, high = (np.searchsorted(runs[order], own, side=s) for s in ("left", "right"))
    n = high - low
    if not n.any():
        return 0.0, 0.0, 0.0
    covered = np.zeros(len(words), bool)
    for k in range(size):
        covered[np.flatnonzero(n) + k] = True
    # the place of the item in the passage that most runs agree on, and a little around it for words put in or left out
    at = order[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)]
    places, agree = np.unique(at - np.repeat(np.arange(len(own)), n), return_counts=True)
    place, slack = int(places[agree.argmax()]), max(SHINGLE, len(words) // 5)
    near = held[max(0, place - slack) : place + len(words) + slack]
    parts = (np.unique(part) for part in (words[:asked], words[asked:]))
    return float(covered.mean()), *[float(np.isin(part, near).mean()) if len(part) else 1.0 for part in parts]


def _terms(texts: list[str]) -> list[np.ndarray]:
    words = textkit.Words(pa.array(texts, pa.large_string()), between=textkit.MARKS)
    hashes = words.hashes()
    return [hashes[a:b] for a, b in zip(words.bounds[:-1], words.bounds[1:])]


@dataclass
class Postings:
    """The entries of a sparse matrix by row."""

    starts: np.ndarray
    columns: np.ndarray
    values: np.ndarray

    @classmethod
    def of(cls, n: int, rows: np.ndarray, columns: np.ndarray, values: np.ndarray) -> Postings:
        """The entries of ``n`` rows, by row and column."""
        order = np.lexsort((columns, rows))
        return cls(np.searchsorted(rows[order], np.arange(n + 1)), columns[order].astype(np.int32), values[order])

    def row(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(columns, values) of one row."""
        at = slice(self.starts[k], self.starts[k + 1])
        return self.columns[at], self.values[at]

    @property
    def nbytes(self) -> int:
        return self.starts.nbytes + self.columns.nbytes + self.values.nbytes

    def expand(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in ``rows``, column, value) for all entries of these rows."""
        n = self.starts[rows + 1] - self.starts[rows]
        place = np.repeat(np.arange(len(rows)), n)
        at = np.arange(len(place)) - np.repeat(np.cumsum(n) - n, n) + self.starts[rows][place]
        return place, self.columns[at], self.values[at]


@dataclass
class Index:
    """An inverted index of test items, small enough to travel with each task."""

    items: list
    words: list  # of each item: its words, and the number of them in its question
    half: int  # words of half a passage
    vocabulary: np.ndarray  # sorted term hashes
    known: np.ndarray  # by the low bits of a hash: some term has them
    impacts: Postings  # the terms of each item, with their shares of the item's own score
    essential: np.ndarray  # terms with an open list
    lists: Postings  # open lists: the items of each term, with their impacts
    blocks: Postings  # the blocks of each open list, with their largest impacts
    closed: np.ndarray  # by item: what its closed lists add in all
    rest: np.ndarray  # by block: the most that is

    @classmethod
    def build(cls, items: list, texts: list[str], df: dict[int, int], total: int, mean_length: float) -> Index:
        terms = _terms(texts)
        vocabulary = np.unique(np.concatenate(terms)) if terms else np.empty(0, np.uint64)
        counts = np.array([df[int(t)] for t in vocabulary.view(np.int64)])
        idf = np.log(1 + (total - counts + 0.5) / (counts + 0.5))
        # entries (term, item), item by item
        entries = []
        closed_sum = np.zeros(len(items))
        for i, own in enumerate(terms):
            at, tf = np.unique(np.searchsorted(vocabulary, own), return_counts=True)
            weight = idf[at] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(own) / mean_length))
            impact = weight / max(weight.sum(), 1e-12)
            # closed lists: the terms of least impact whose sum stays below the threshold
            order = np.argsort(impact, kind="stable")
            closed = np.zeros(len(at), bool)
            closed[order] = np.cumsum(impact[order]) < CLOSED
            closed_sum[i] = impact[closed].sum()
            entries.append((at, np.full(len(at), i), impact, ~closed))
        term, item, impact, open_ = (np.concatenate(x) for x in zip(*entries))
        impacts = Postings.of(len(items), item, term, impact)
        lists = Postings.of(len(vocabulary), term[open_], item[open_], impact[open_])
        blocks = -(-len(items) // BLOCK)
        pairs, inverse = np.unique(term[open_] * blocks + item[open_] // BLOCK, return_inverse=True)
        most = np.zeros(len(pairs))
        np.maximum.at(most, inverse, impact[open_])
        block_max = Postings.of(len(vocabulary), pairs // blocks, pairs % blocks, most)
        rest = np.pad(closed_sum, (0, blocks * BLOCK - len(items))).reshape(blocks, BLOCK).max(axis=1)
        known = np.zeros(_KNOWN, bool)
        known[(vocabulary & np.uint64(_KNOWN - 1)).astype(np.int64)] = True
        parts = zip(*map(question_and_answer, texts))
        words = [(np.concatenate(both), len(both[0])) for both in zip(*[_terms(list(part)) for part in parts])]
        half = max(PASSAGE // 2, max((len(t) for t in terms), default=0))
        return cls(items, words, half, vocabulary, known, impacts, np.diff(lists.starts) > 0, lists, block_max, closed_sum, rest)

    @property
    def nbytes(self) -> int:
        """Bytes of the arrays that grow with the items."""
        own = sum(w.nbytes for w, _ in self.words) + sum(x.nbytes for x in (self.vocabulary, self.essential, self.closed, self.rest))
        return own + sum(x.nbytes for x in (self.impacts, self.lists, self.blocks))

    @property
    def impact(self) -> np.ndarray:
        """The dense (term, item) matrix, for a look at small indexes."""
        dense = np.zeros((len(self.vocabulary), len(self.items)))
        for i in range(len(self.items)):
            at, values = self.impacts.row(i)
            dense[at, i] = values
        return dense

    def lookup(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions, terms) of the words that the vocabulary holds."""
        at = np.flatnonzero(self.known[(hashes & np.uint64(_KNOWN - 1)).astype(np.int64)])
        term = np.searchsorted(self.vocabulary, hashes[at])
        some = self.vocabulary[np.minimum(term, len(self.vocabulary) - 1)] == hashes[at]
        return at[some], term[some]

    def retrieve(self, hashes: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, int, float]]:
        """(document, passage, item, score) for every item at or above the threshold."""
        if not len(self.vocabulary) or not len(hashes):
            return
        at, term = self.lookup(hashes)
        doc = np.searchsorted(bounds, at, side="right") - 1
        half_of = (at - bounds[doc]) // self.half
        # a passage is two neighbouring halves; a half is in the passage it begins and in the one it ends
        halves = np.maximum(1, -(-np.diff(bounds) // self.half))
        first = np.concatenate(([0], np.cumsum(halves)))
        place = first[doc] + half_of
        # open lists: distinct (passage, term)
        strong = self.essential[term]
        hit, hit_term = place[strong], term[strong]
        later = half_of[strong] > 0
        keys = np.unique(np.concatenate((hit, hit[later] - 1)) * len(self.vocabulary) + np.concatenate((hit_term, hit_term[later])))
        passage, t = keys // len(self.vocabulary), keys % len(self.vocabulary)
        if not len(t):
            return
        # block maxima: only blocks that can hold an item at the threshold stay
        row, block, most = self.blocks.expand(t)
        found, inverse = np.unique(passage[row] * len(self.rest) + block, return_inverse=True)
        bound = np.bincount(inverse, most) + self.rest[found % len(self.rest)]
        found = found[bound >= THRESHOLD - 1e-9]
        # their items, by what the open lists hold of each and the most its closed lists add
        row, item, share = self.lists.expand(t)
        open_block = passage[row] * len(self.rest) + item // BLOCK
        at_found = np.minimum(np.searchsorted(found, open_block), max(len(found) - 1, 0))
        stay = found[at_found] == open_block if len(found) else np.zeros(len(row), bool)
        pairs, inverse = np.unique(passage[row[stay]] * len(self.items) + item[stay], return_inverse=True)
        bound = np.bincount(inverse, share[stay], minlength=len(pairs)) + self.closed[pairs % len(self.items)]
        # full scores for the items left
        order = np.argsort(place, kind="stable")
        placed, terms = place[order], term[order]
        for pair in pairs[bound >= THRESHOLD - 1e-9].tolist():
            one, i = divmod(pair, len(self.items))
            d = int(np.searchsorted(first, one, side="right") - 1)
            own = np.unique(terms[np.searchsorted(placed, one) : np.searchsorted(placed, min(one + 2, first[d + 1]))])
            at, values = self.impacts.row(i)
            score = float(values[np.isin(at, own)].sum())
            if score >= THRESHOLD - 1e-9:
                yield d, int(one - first[d]), i, score

    def leaks(self, texts: pa.Array) -> Iterator[tuple[int, int, float, float, float]]:
        """(row, item, score, question overlap, answer overlap) for verified items, the best passage of each."""
        for start, part in textkit.pieces(texts):
            words = textkit.Words(part, between=textkit.MARKS)
            hashes, bounds = words.hashes(), words.bounds
            best: dict[tuple[int, int], tuple[float, float, float]] = {}
            for d, passage, i, score in self.retrieve(hashes, bounds):
                begin = bounds[d] + passage * self.half
                held = hashes[begin : min(begin + 2 * self.half, bounds[d + 1])]
                shares = overlaps(*self.words[i], held)
                if min(shares) >= OVERLAP and best.get((d, i), (0.0,))[0] < score:
                    best[d, i] = (score, *shares[1:])
            for (d, i), figures in sorted(best.items()):
                yield start + d, i, *figures


def _indexes(items: DataFrame) -> Iterator[Index]:
    """Indexes of about INDEX_BYTES each, with term statistics of all items."""
    scratch = Scratch(items.sparkSession, "decontaminate")

    def terms_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(t).view(np.int64) for t in _terms(batch.column(0).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found) if found else [], pa.int64())], names=["term"])

    items = items.filter("text is not null")
    words = F.regexp_count("text", F.lit(r"[^\x00-\x2F:-@\[-`{-\x7F]+"))
    items, seen = scratch.save_counted(items.withColumn("words", words).filter("words > 0"), "items", words=F.sum("words"))
    if not seen["n"]:
        return
    counts = scratch.save(items.select("text").mapInArrow(terms_of, "term bigint").groupBy("term").agg(F.count(F.lit(1)).alias("df")), "counts")
    blocks = -(-(WORD_BYTES * seen["words"] + ITEM_BYTES * seen["n"]) // INDEX_BYTES)
    block = F.pmod(F.xxhash64("item"), F.lit(blocks))
    for b in range(blocks):
        # a stated part of the test items, whose index takes about INDEX_BYTES
        chosen = items.filter(block == b)
        rows = sorted((r["item"], r["text"]) for r in chosen.collect())
        own = chosen.select("text").mapInArrow(terms_of, "term bigint").distinct()
        df = {r["term"]: r["df"] for r in counts.join(own, "term").collect()}
        if rows:
            yield Index.build([r[0] for r in rows], [r[1] for r in rows], df, seen["n"], seen["words"] / seen["n"])


def find_leaks(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id") -> DataFrame:
    """``(id, item, score, question_overlap, answer_overlap)`` for every test item a document holds.

    Words are compared without case of A to Z and without ASCII punctuation. Every
    passage of every text is searched, whatever its length. Null and empty texts
    hold nothing; null items and items without words are held by nothing. Items
    with equal texts, and rows with equal ids, are reported each. Without items or
    documents there are no rows. Other columns are ignored.
    """
    slim = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    id_kind, item_kind = slim.schema["id"].dataType, items.schema[item_column].dataType
    shape = f"{id_column} {id_kind.simpleString()}, {item_column} {item_kind.simpleString()}, score double, question_overlap double, answer_overlap double"
    found = docs.sparkSession.createDataFrame([], shape)
    for index in _indexes(items.select(F.col(item_column).alias("item"), "text")):

        def search(batches: Iterator[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = list(index.leaks(batch.column(1)))
                ids = batch.column(0).take(pa.array([r[0] for r in rows], pa.int64()))
                held = pa.array([index.items[r[1]] for r in rows], ITEM)
                yield pa.RecordBatch.from_arrays(
                    [ids, held, *[pa.array([r[k] for r in rows], pa.float64()) for k in (2, 3, 4)]],
                    names=[id_column, item_column, "score", "question_overlap", "answer_overlap"],
                )

        ITEM = to_arrow_type(item_kind)
        found = found.union(slim.mapInArrow(search, shape))
    return found


def drop_contaminated(docs: DataFrame, items: DataFrame, text_column: str = "text", item_column: str = "item_id") -> DataFrame:
    """``docs`` without the documents that hold a test item; all columns are kept, null texts stay."""
    at = docs.columns.index(text_column)
    for index in _indexes(items.select(F.col(item_column).alias("item"), "text")):

        def clean(batches: Iterator[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                keep[[r[0] for r in index.leaks(batch.column(at))]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
