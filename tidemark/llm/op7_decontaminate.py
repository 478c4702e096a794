"""Benchmark decontamination: BM25 with block-max WAND, then question and answer overlap.

The test items are the indexed side: an inverted index with BM25 impacts, each divided by the item's own score, so that 1
is a passage that holds the whole item, and one threshold serves all items. Training texts are the queries: every passage
of `passage` words (an even number, 2 at least), a new one each half passage, over the whole of every text. An item of more
than a passage's words is indexed in pieces of at most half a passage, each of which lies whole in some passage of a text
that holds it, is scored like an item of its own and retrieves the item; its score is that of its best piece.

A passage is dropped when the sum of its terms' greatest impacts is below the threshold, overall or in each range of pieces;
that is done for whole batches of passages at once. The others are answered by block-max WAND: cursors on the postings of their terms, in order of pieces; the pivot is the first piece that the greatest
impacts of the cursors before it can bring to the threshold; it is scored only if the maxima of the posting blocks around it
can too, and otherwise the cursors skip to where one of these blocks ends. Everything at or above the threshold is
retrieved. A retrieved item counts as a leak if both its question and its answer (its last sentence, or its second half if
it has one sentence) overlap with the document: the share of their words in runs of `run` words that the document has too.

Document frequencies, the number of items and the mean length are those of the whole benchmark, counted by Spark. The index
is split into as many parts as max_items asks for, each part a pass over the documents, so what is sent to tasks is bounded
however long the benchmark is, and scores don't depend on the parts. Null or empty texts and items match nothing. Rows are
treated one by one, so repeated rows give repeated results; null ids pass through. Empty tables give empty results; extra
columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Batch, cut, ngram_hash, parts, word_hashes
from .op8_license import _GAP

#: Postings of a block, and pieces of a range.
BLOCK, RANGE = 8, 4


def split_item(text: str) -> tuple[str, str]:
    """Question and answer of an item."""
    at = [m.end() for m in re.finditer(r"[.?!:](?=\s)|\n", text.rstrip())]
    if at and text[: at[-1]].strip() and text[at[-1] :].strip():
        return text[: at[-1]], text[at[-1] :]
    words = text.split()
    return " ".join(words[: (len(words) + 1) // 2]), " ".join(words[(len(words) + 1) // 2 :])


def _hashes(texts: list[str]) -> list[np.ndarray]:
    import pyarrow as pa

    words, bounds = word_hashes(Batch(pa.array(texts, pa.string())), _GAP)
    return [words[i:j] for i, j in zip(bounds[:-1], bounds[1:], strict=True)]


def pieces(words: np.ndarray, passage: int) -> list[np.ndarray]:
    """What is indexed of an item: all its words if a passage can hold them, else even pieces of at most half a passage."""
    return [words] if len(words) <= passage else np.array_split(words, -(-len(words) // max(1, passage // 2)))


class Statistics:
    """What BM25 asks of the whole benchmark: n items, mean length of a piece, df of each term (sorted hashes)."""

    def __init__(self, n: int, mean: float, terms: np.ndarray, df: np.ndarray):
        self.n, self.mean, self.terms, self.df = n, mean, terms, df

    @classmethod
    def of(cls, words: list[np.ndarray], passage: int) -> Statistics:
        terms, df = np.unique(np.concatenate([np.unique(w) for w in words]), return_counts=True) if words else (np.zeros(0, np.uint64), np.zeros(0))
        sizes = [len(p) for w in words for p in pieces(w, passage)]
        return cls(len(words), float(np.mean(sizes)) if sizes else 1.0, terms, df)


class Index:
    """Terms (sorted hashes) and their postings: pieces in order with normalised impacts, in blocks of BLOCK postings that each
    keep their last piece and their greatest impact."""

    def __init__(self, items: list[tuple], run: int, k1: float = 1.2, b: float = 0.75, passage: int = 64, statistics: Statistics | None = None):
        items = [(i, t) for i, t in items if t and t.strip()]
        words = _hashes([t for _, t in items])
        self.ids = [i for (i, _), w in zip(items, words, strict=True) if len(w)]
        words, texts = [w for w in words if len(w)], [t for (_, t), w in zip(items, words, strict=True) if len(w)]
        whole = statistics or Statistics.of(words, passage)
        n = len(words)
        self.terms = np.unique(np.concatenate(words)) if n else np.zeros(0, np.uint64)
        df = whole.df[np.searchsorted(whole.terms, self.terms)]
        idf = np.log(1 + (whole.n - df + 0.5) / (df + 0.5))
        cut_up = [pieces(w, passage) for w in words]
        self.owner = np.repeat(np.arange(n), [len(x) for x in cut_up])  # the item of each piece
        pairs = [np.unique(np.searchsorted(self.terms, w), return_counts=True) for x in cut_up for w in x]
        impacts = [idf[t] * tf * (k1 + 1) / (tf + k1 * (1 - b + b * tf.sum() / whole.mean)) for t, tf in pairs]
        term = np.concatenate([p[0] for p in pairs]) if n else np.zeros(0, np.int64)
        piece = np.repeat(np.arange(len(pairs)), [len(p[0]) for p in pairs])
        weight = np.concatenate([x / x.sum() for x in impacts]) if n else np.zeros(0)
        order = np.lexsort((piece, term))
        self.piece, self.weight = piece[order], weight[order]
        self.first = np.searchsorted(term[order], np.arange(len(self.terms) + 1))
        blocks = -(-np.diff(self.first) // BLOCK)
        self.block_first = np.concatenate([[0], np.cumsum(blocks)]).astype(np.int64)
        starts = np.repeat(self.first[:-1], blocks) + BLOCK * (np.arange(self.block_first[-1]) - np.repeat(self.block_first[:-1], blocks))
        ends = np.minimum(starts + BLOCK, np.repeat(self.first[1:], blocks))
        self.block_last = self.piece[ends - 1]
        self.block_max = np.maximum.reduceat(self.weight, starts) if len(starts) else np.zeros(0)
        self.bound = np.maximum.reduceat(self.weight, self.first[:-1]) if len(self.terms) else np.zeros(0)
        # the greatest impact of a term in each range of RANGE pieces that it has
        of_range = term[order] * (len(pairs) // RANGE + 1) + self.piece // RANGE
        new = np.flatnonzero(np.concatenate([[True], of_range[1:] != of_range[:-1]])) if n else np.zeros(0, np.int64)
        self.ranges = len(pairs) // RANGE + 1
        self.range_of, self.range_max = self.piece[new] // RANGE, np.maximum.reduceat(self.weight, new) if n else np.zeros(0)
        self.range_first = np.searchsorted(term[order][new], np.arange(len(self.terms) + 1))
        halves = [split_item(t) for t in texts]
        self.parts = [tuple((h, ngram_hash(h, min(run, len(h)))) for h in pair) for pair in zip(_hashes([q for q, _ in halves]), _hashes([a for _, a in halves]), strict=True)]
        self._lists = None

    def reachable(self, row: np.ndarray, term: np.ndarray, least: float) -> np.ndarray:
        """For passages 0, 1, ... (row, ascending) with their distinct terms: whether the greatest impacts in some range of
        pieces add up to least. Some million cells at a time."""
        size = np.bincount(row)
        out = np.zeros(len(size), bool)
        step = max(1, (1 << 21) // self.ranges)
        cuts = np.concatenate([[0], np.cumsum(size)])
        for start in range(0, len(size), step):
            stop = min(len(size), start + step)
            r, t = row[cuts[start] : cuts[stop]] - start, term[cuts[start] : cuts[stop]]
            count = self.range_first[t + 1] - self.range_first[t]
            at = np.repeat(self.range_first[t] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
            upper = np.bincount(np.repeat(r, count) * self.ranges + self.range_of[at], weights=self.range_max[at], minlength=(stop - start) * self.ranges)
            out[start:stop] = (upper.reshape(-1, self.ranges) >= least).any(axis=1)
        return out

    def wand(self, terms: list[int], threshold: float) -> list[tuple[int, float]]:
        """(piece, score) of all pieces that the distinct terms of a passage bring to the threshold."""
        if self._lists is None:
            self._lists = [x.tolist() for x in (self.piece, self.weight, self.first, self.block_first, self.block_last, self.block_max, self.bound)]
        piece, weight, first, block_first, block_last, block_max, bound = self._lists
        # a cursor: its piece, its posting, the end of its postings, its block, the end of its blocks, its term's bound
        cursors = [[piece[first[t]], first[t], first[t + 1], block_first[t], block_first[t + 1], bound[t]] for t in terms]
        safe = threshold - 1e-9
        found = []
        while cursors:
            cursors.sort()
            total, pivot = 0.0, -1
            for k, c in enumerate(cursors):
                total += c[5]
                if total >= safe:
                    pivot = k
                    break
            if pivot < 0:
                break
            at = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == at:
                pivot += 1
            near, beyond = 0.0, cursors[pivot + 1][0] if pivot + 1 < len(cursors) else piece[-1] + len(piece)
            for c in cursors[: pivot + 1]:
                while c[3] < c[4] and block_last[c[3]] < at:
                    c[3] += 1
                if c[3] < c[4]:
                    near += block_max[c[3]]
                    beyond = min(beyond, block_last[c[3]] + 1)
            if near < safe:
                to = beyond
            elif cursors[0][0] == at:
                score = sum(weight[c[1]] for c in cursors[: pivot + 1])
                if score >= threshold:
                    found.append((at, score))
                to = at + 1
            else:
                to = at
            done = False
            for c in cursors[: pivot + 1]:
                if c[0] < to:
                    c[1] = bisect_left(piece, to, c[1], c[2])
                    if c[1] < c[2]:
                        c[0] = piece[c[1]]
                    else:
                        c[0], done = None, True
            if done:
                cursors = [c for c in cursors if c[0] is not None]
        return found


def overlap(part: tuple[np.ndarray, np.ndarray], doc: np.ndarray) -> float:
    """Share of the part's words that lie in runs which the document has; 1 for a part without words."""
    words, grams = part
    if not len(words):
        return 1.0
    hit = np.isin(grams, ngram_hash(doc, len(words) - len(grams) + 1))
    width = len(words) - len(grams) + 1
    covered = np.zeros(len(words), bool)
    for k in np.flatnonzero(hit):
        covered[k : k + width] = True
    return float(covered.mean())


def retrieve(index: Index, words: np.ndarray, bounds: np.ndarray, passage: int, threshold: float) -> list[tuple[int, int, float]]:
    """(text, item, best score of its passages) of all items with a piece that reaches the threshold in some passage."""
    step = passage // 2
    place = np.searchsorted(index.terms, words)
    place[place == len(index.terms)] = 0
    known = np.flatnonzero(index.terms[place] == words) if len(index.terms) else np.zeros(0, np.int64)
    if not len(known):
        return []
    term = place[known]
    sizes = np.diff(bounds)
    cells = -(-sizes // step) + 1  # one empty cell after each text
    base = np.concatenate([[0], np.cumsum(cells)])
    text = np.searchsorted(bounds, known, side="right") - 1
    cell = base[text] + (known - bounds[text]) // step
    sums = np.bincount(cell, weights=index.bound[term], minlength=base[-1] + 1)
    both = sums[:-1] + sums[1:]  # passage p is cells p and p + 1
    both[base[1:] - 1] = -1.0  # the empty cell and the next text's first
    live = np.flatnonzero(both >= threshold)
    if not len(live):
        return []
    number = np.full(len(sums), -1, np.int64)
    number[live] = np.arange(len(live))
    both = np.concatenate([number[cell], np.where(cell > 0, number[cell - 1], -1)])
    pairs = np.unique((both * len(index.terms) + np.concatenate([term, term]))[both >= 0])  # distinct terms of each passage
    row, term = pairs // len(index.terms), pairs % len(index.terms)
    cuts = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1], [True]]))
    enough = np.flatnonzero(index.reachable(np.repeat(np.arange(len(cuts) - 1), np.diff(cuts)), term, threshold - 1e-9))
    owner = np.searchsorted(base, live[row[cuts[:-1]]], side="right") - 1
    best: dict[tuple[int, int], float] = {}
    for k in enough.tolist():
        for piece, score in index.wand(term[cuts[k] : cuts[k + 1]].tolist(), threshold):
            pair = int(owner[k]), int(index.owner[piece])
            best[pair] = max(best.get(pair, 0.0), score)
    return [(d, i, s) for (d, i), s in sorted(best.items())]


def _counted(benchmark: DataFrame, passage: int) -> tuple[DataFrame, DataFrame]:
    """(n_words, n_pieces of each item; term, df over the whole benchmark)."""

    def sizes(batches):
        import pyarrow as pa

        for b in (p for batch in batches for p in parts(batch)):
            words, bounds = word_hashes(Batch(b.column("text")), _GAP)
            n = np.diff(bounds)
            yield pa.RecordBatch.from_arrays([pa.array(n), pa.array([len(pieces(words[i:j], passage)) for i, j in zip(bounds[:-1], bounds[1:], strict=True)], pa.int64())], ["n_words", "n_pieces"])

    def terms(batches):
        import pyarrow as pa

        for b in (p for batch in batches for p in parts(batch)):
            words, bounds = word_hashes(Batch(b.column("text")), _GAP)
            distinct = [np.unique(words[i:j]) for i, j in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, np.uint64), *distinct]).view(np.int64))], ["term"])

    text = benchmark.select("text")
    return text.mapInArrow(sizes, "n_words long, n_pieces long"), text.mapInArrow(terms, "term long").groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def indexes(benchmark: DataFrame, passage: int, run: int, max_items: int) -> list[Index]:
    """The index of each part of at most about max_items pieces, with the statistics of the whole benchmark."""
    sizes, frequency = _counted(benchmark, passage)
    n, words, n_pieces = sizes.filter("n_words > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n_words"), F.lit(0)), F.coalesce(F.sum("n_pieces"), F.lit(0))).first()
    count = max(1, -(-n_pieces // max_items))
    frequency = cut(frequency) if count > 1 else frequency
    made = []
    for k in range(count):
        part = benchmark.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == k)
        own = frequency if count == 1 else frequency.join(_counted(part, passage)[1].select("term"), "term", "left_semi")
        df = own.toPandas()
        terms = df["term"].to_numpy(np.int64).view(np.uint64)
        order = np.argsort(terms)
        known = Statistics(n, words / n_pieces if n_pieces else 1.0, terms[order], df["df"].to_numpy(np.int64)[order])
        made.append(Index([tuple(r) for r in part.collect()], run, passage=passage, statistics=known))
    return made


def leaks(docs: DataFrame, benchmark: DataFrame, passage: int = 64, threshold: float = 0.4, run: int = 3, question: float = 0.6, answer: float = 0.6, max_items: int = 2000) -> DataFrame:
    """doc_id, item_id, score, question_overlap, answer_overlap of each leaked item of each document."""
    passage = max(2, passage // 2 * 2)
    benchmark = benchmark.select("item_id", "text")
    kinds = docs.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType
    passes = [_pass(docs, index, kinds, passage, threshold, question, answer) for index in indexes(benchmark, passage, run, max_items)]
    return reduce(DataFrame.unionByName, passes)


def _pass(docs, index, kinds, passage, threshold, question, answer):
    doc_kind, item_kind = kinds
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_type

        index, item_type = shared.value, to_arrow_type(item_kind)
        for b in (p for batch in batches for p in parts(batch)):
            words, bounds = word_hashes(Batch(b.column("text")), _GAP)
            rows = []
            for d, i, score in retrieve(index, words, bounds, passage, threshold):
                q, a = (overlap(p, words[bounds[d] : bounds[d + 1]]) for p in index.parts[i])
                if q >= question and a >= answer:
                    rows.append((d, i, score, q, a))
            d, i, s, q, a = zip(*rows, strict=True) if rows else ((),) * 5
            item = pa.array([index.ids[x] for x in i], item_type)
            yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(d, pa.int64())), item, *(pa.array(x, pa.float64()) for x in (s, q, a))], ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {doc_kind}, item_id {item_kind.simpleString()}, score double, question_overlap double, answer_overlap double")


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of docs without a leak, with the columns of docs."""
    found = leaks(docs, benchmark, **options).select(F.col("doc_id").alias("_leaked")).distinct()
    return docs.join(found, docs["doc_id"].eqNullSafe(found["_leaked"]), "left_anti")
