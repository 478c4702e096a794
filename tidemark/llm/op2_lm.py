"""Hierarchical Pitman-Yor language model of words and their spellings.

Common words (at least 1 / 2 ** class_bits of the training tokens each, so at most 2 ** class_bits of them) are classes of
their own; all other words are rare and share classes by their last two bytes (ENDINGS of them), and the end of a text has
a class too. Three models are learnt:

* classes: a restaurant for each context (the last class before that isn't rare, which carries the language over rare
  words), all sharing one parent restaurant over classes, with a uniform base;
* spellings of rare words: a restaurant for each four previous bytes, sharing parents for the last three, and so on to one
  root with a uniform base. Above it a restaurant over the rare words of each ending has the spelling model as its base.
* words in context (see places and in_context): a restaurant for each rare word, over all words and the end that follow it,
  and one for each class before and class of rare words, over those words. Their base is what the first two models say.
  Classes before classes are in the first model already. So every word is a context, and every word a dish of it. The first
  two models learn from all tokens, and not from the tables of this one.

Seating is sampled: in each sweep, level by level, the customers of each dish of each restaurant are taken out and seated
again one after another by the Chinese-restaurant rule, given everybody else; each new table sends a customer to the
parent. (Customers beyond the first 64 of a dish are drawn in blocks of an eighth of those seated, one binomial a block.)
After burn-in the predictive probabilities of the sweeps are averaged, and log10 probabilities of whole texts, hence
perplexities, come from the averages.

What Spark does: counts of words, class pairs and spelling n-grams are combined in each task and summed by a shuffle. The
table of pairs is bounded by the classes, and its sweeps run on the driver. The order of spelling is the same at any size: its
restaurants are dealt to tasks by the two nearest bytes of their context, which keeps a restaurant with all that it descends
from down to those two bytes, and a sweep is one step of Spark; the restaurants of one byte and the root (257 * 257 dishes at
most) are seated on the driver in between. The vocabulary is never collected: rare words keep a table of their own, get their
probability there from n-grams dealt out in the same way. The occurrences of words in context are dealt out by context, in
loads of a million with the numbers of their documents; the words beyond 2 ** common_bits join the rare words first. A task
has all occurrences of its contexts, seats those of training text in all sweeps, and sends sums by document back to the load.

Null text is empty: its one token is the end. Each row is a document of its own, also where it repeats a doc_id (null too) or
is equal to another. Draws depend on the word or n-gram and the seed alone, so scores are the same at any partitioning (but
for the order in which numbers are added). Without training text every word is unknown. Empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

import math
from itertools import pairwise

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Batch, cut, mix, partitions, parts, prefix_hash, span_hash


# ---- the sampler ----


class Draws:
    """Random numbers of dishes that depend on the dish and the seed alone, whatever else is drawn beside them: tasks may hold
    any share of the dishes, and a task that runs again draws the same."""

    def __init__(self, keys: np.ndarray, *seed: int):
        self.base = mix(keys.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        for x in seed:
            self.base = mix(self.base + np.uint64(x % 2**64 + 1))
        self.step = 0

    def _uniform(self, of: np.ndarray) -> np.ndarray:
        self.step += 1
        return ((mix(self.base[of] + np.uint64(self.step * 0xD1B54A32D192ED03 % 2**64)) >> np.uint64(11)).astype(np.float64) + 0.5) / 2**53

    def binomial(self, of: np.ndarray, n: np.ndarray, p: np.ndarray) -> np.ndarray:
        """A draw for each dish in of: by inversion where the variance is below 9, rounded from a normal draw above."""
        u = self._uniform(of)
        out = (u < p).astype(np.int64)
        many = np.flatnonzero(n > 1)
        if not len(many):
            return out
        m, q, v = n[many].astype(np.float64), p[many], self._uniform(of[many])
        mean, spread = m * q, np.sqrt(m * q * (1 - q))
        normal = np.sqrt(-2 * np.log(u[many])) * np.cos(2 * np.pi * v)
        drawn = np.clip(np.rint(mean + spread * normal), 0, m)
        few = np.flatnonzero(spread < 3)
        if len(few):
            flip = q[few] > 0.5
            r, k, left = np.where(flip, 1 - q[few], q[few]), np.zeros(len(few)), u[many][few].copy()
            term = (1 - r) ** m[few]
            live = np.arange(len(few))
            while len(live):
                live = live[(left[live] > term[live]) & (k[live] < m[few][live])]
                left[live] -= term[live]
                term[live] *= (m[few][live] - k[live]) / (k[live] + 1) * r[live] / (1 - r[live])
                k[live] += 1
            drawn[few] = np.where(flip, m[few] - k, k)
        out[many] = drawn.astype(np.int64)
        return out


def seat(count: np.ndarray, d: float | np.ndarray, strength: np.ndarray, others: np.ndarray, prior: np.ndarray, draws: Draws) -> np.ndarray:
    """Tables of each dish after seating its customers in turn.

    count: customers of the dish; strength + d * tables is the weight of a new table (d: one number, or one for each dish),
    others: the restaurant's tables of other dishes; prior: the parent's probability of the dish.
    """
    tables, d = (count > 0).astype(np.int64), np.broadcast_to(d, count.shape)
    seated = tables.copy()
    live = np.flatnonzero(count > 1)
    while len(live):
        t, s, own = tables[live], seated[live], d[live]
        block = np.minimum(np.where(s < 64, 1, s // 8), count[live] - s)
        new = (strength[live] + own * (others[live] + t)) * prior[live]
        tables[live] += draws.binomial(live, block, np.clip(new / (new + s - own * t), 0.0, 1.0))
        seated[live] += block
        live = live[seated[live] < count[live]]
    return tables


def discount(count: np.ndarray) -> float:
    """Absolute discount from the dishes with one and with two customers."""
    one, two = int((count == 1).sum()), int((count == 2).sum())
    return min(0.95, max(0.05, one / (one + 2 * two))) if one + two else 0.5


def predictive(count, tables, d, strength, parent):
    """P(dish | restaurant); the last axis are dishes."""
    c, t = count.sum(-1, keepdims=True), tables.sum(-1, keepdims=True)
    return (np.maximum(count - d * tables, 0.0) + (strength + d * t) * parent) / (strength + c)


def fit(counts: np.ndarray, sweeps: int, burn: int, seed: int, strength: float = 1.0) -> np.ndarray:
    """Averaged predictive probabilities, of the shape of counts: axes are the context from far to near, then the dish.

    The parent of a context lacks its first symbol.
    """
    levels = [counts]
    while levels[0].ndim > 1:
        levels.insert(0, np.minimum(levels[0], 1).sum(axis=0))
    levels = [x.astype(np.int64) for x in levels]
    tables = [np.minimum(x, 1) for x in levels]
    base = 1.0 / counts.shape[-1]
    total = np.zeros(counts.shape, np.float64)
    for sweep in range(sweeps):
        discounts = [discount(x) for x in levels]
        probability, parent = [], base
        for x, t, d in zip(levels, tables, discounts, strict=True):
            parent = predictive(x, t, d, strength, parent)
            probability.append(parent)
        for k in range(len(levels) - 1, -1, -1):
            x, t, d = levels[k], tables[k], discounts[k]
            prior = np.broadcast_to(probability[k - 1] if k else base, x.shape)
            at = np.nonzero(x)
            others = np.broadcast_to(t.sum(-1, keepdims=True), x.shape)[at] - t[at]
            tables[k] = np.zeros_like(x)
            tables[k][at] = seat(x[at], d, np.full(len(at[0]), strength), others, prior[at], Draws(np.ravel_multi_index(at, x.shape), seed, sweep, k))
            if k:
                levels[k - 1] = tables[k].sum(axis=0)
        if sweep >= burn:
            parent = base
            for x, t, d in zip(levels, tables, discounts, strict=True):
                parent = predictive(x, t, d, strength, parent)
            total += parent
    return total / (sweeps - burn)


# ---- counting in tasks ----


def _released(run):
    """run, after which a worker gives back what Arrow keeps of memory that is free: it waits for its next task beside others."""

    def task(batches):
        import pyarrow as pa

        yield from run(batches)
        pa.default_memory_pool().release_unused()

    return task


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 1, F.lit(False))


def _tokens(column):
    """(Batch, starts, ends, bounds, hashes) of the lower-cased words."""
    texts = Batch(column)
    starts, ends, bounds = texts.words()
    return texts, starts, ends, bounds, span_hash(prefix_hash(texts.data), starts, ends)


def _cut_out(data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """data[start:end] of each word as an Arrow array."""
    import pyarrow as pa

    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=offsets[1:])
    flat = data[np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], ends - starts)]
    return pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(flat))


#: Bytes of distinct words and their counts that a task merges before it sends them off.
MERGE = 1 << 24


def word_counts(docs: DataFrame) -> DataFrame:
    """h (hash), word, n, n_train of every distinct word of docs (text, held)."""

    def run(batches):
        import pyarrow as pa

        have, least, size = [[], [], [], []], 0, 0  # h, word, n, n_train: pieces; the first has least bytes if merged, others size

        def merge():
            """One column after the other, each one's pieces let go."""
            h = np.concatenate(have[0])
            order = np.argsort(h)
            h = h[order]
            first = np.flatnonzero(np.diff(h, prepend=~h[0]))
            have[0][:] = [h[first]]
            for x in have[2:]:
                x[:] = [np.add.reduceat(np.concatenate(x)[order], first)]
            order = order[first]
            have[1][:] = [pa.concat_arrays(have[1]).take(pa.array(order))]

        def sent():
            (h,), (word,), (n,), (train,) = have
            for i in range(0, len(h), 100_000):
                part = slice(i, i + 100_000)
                yield pa.RecordBatch.from_arrays([pa.array(h[part].view(np.int64)), word[part], pa.array(n[part]), pa.array(train[part])], ["h", "word", "n", "n_train"])
            for x in have:
                x.clear()

        for b in (p for batch in batches for p in parts(batch, limit=SLICE)):
            texts, starts, ends, bounds, h = _tokens(b.column("text"))
            if not len(h):
                continue
            train = np.repeat(~b.column("held").to_numpy(zero_copy_only=False), np.diff(bounds)).astype(np.int64)
            order = np.argsort(h)
            h = h[order]
            first = np.flatnonzero(np.diff(h, prepend=~h[0]))
            word = _cut_out(texts.data, starts[order[first]], ends[order[first]])
            for c, x in zip(have, (h[first], word, np.diff(first, append=len(h)), np.add.reduceat(train[order], first)), strict=True):
                c.append(x)
            size += word.nbytes + 24 * len(first)
            if size > max(least, MERGE // 4):
                merge()
                least, size = have[1][0].nbytes + 24 * len(have[0][0]), 0
                if least > MERGE:
                    yield from sent()
                    least = 0
        if have[0]:
            merge()
            yield from sent()

    part = docs.select("text", "held").mapInArrow(_released(run), "h long, word string, n long, n_train long")
    return part.groupBy("h").agg(F.first("word").alias("word"), F.sum("n").alias("n"), F.sum("n_train").alias("n_train"))


ENDINGS = 64
#: Bytes of text that a task turns into words at once; the arrays of a slice take some 60 bytes for each of them.
SLICE = 1 << 18


def _ending(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The last two bytes of each word as a number; of a single byte, that byte."""
    two = np.where(ends - starts > 1, data[np.maximum(ends - 2, 0)], 0).astype(np.int64)
    return two << 8 | data[ends - 1]


def endings(words: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class of each ending, types and tokens of each class) of rare words (word, n_train): the ENDINGS - 1 endings with
    most tokens have a class each, all others share the last."""
    last = F.hex(F.substring(F.encode("word", "utf-8"), -2, 2))
    found = words.groupBy(last.alias("e")).agg(F.count(F.lit(1)).alias("types"), F.sum("n_train").alias("mass")).toPandas()  # 65,792 rows at most
    found = found.sort_values(["mass", "e"], ascending=[False, True])
    of = np.full(1 << 16, ENDINGS - 1, np.int64)
    types, mass = np.zeros(ENDINGS), np.zeros(ENDINGS)
    for k, (e, t, m) in enumerate(zip(found["e"], found["types"], found["mass"], strict=True)):
        c = min(k, ENDINGS - 1)
        of[int(e, 16)] = c
        types[c] += t
        mass[c] += m
    return of, np.maximum(types, 1), mass


def class_counts(docs: DataFrame, classes: np.ndarray, ending_of: np.ndarray) -> np.ndarray:
    """Counts of (context, class); classes: sorted hashes of the common words. After them come the rare classes, then the end."""
    k = len(classes) + ENDINGS + 1

    def run(batches):
        import pyarrow as pa

        total = np.zeros(k * k, np.int64)
        for b in (p for batch in batches for p in parts(batch, limit=SLICE)):
            texts, starts, ends, bounds, h = _tokens(b.column("text"))
            before, now = _pairs(_classes(h, classes, ending_of[_ending(texts.data, starts, ends)]), bounds, k - 1)
            u, n = np.unique(before * k + now, return_counts=True)
            total[u] += n
        at = np.flatnonzero(total)
        for i in range(0, len(at), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(at[i : i + 100_000]), pa.array(total[at[i : i + 100_000]])], ["pair", "n"])

    cells = docs.filter("NOT held").select("text").mapInArrow(_released(run), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    return _dense(cells, "pair", (k, k))


def _dense(cells: DataFrame, key: str, shape) -> np.ndarray:
    """A bounded table of counts as an array."""
    flat = np.zeros(math.prod(shape), np.int64)
    for x, n in cells.select(key, "n").toLocalIterator():
        flat[x] = n
    return flat.reshape(shape)


def _classes(h: np.ndarray, classes: np.ndarray, ending: np.ndarray) -> np.ndarray:
    at = np.searchsorted(classes, h)
    at[at == len(classes)] = 0
    return np.where(classes[at] == h, at, len(classes) + ending) if len(classes) else ending


def _pairs(c: np.ndarray, bounds: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """(context, class) of each token, ends included. The context is the last class before that isn't rare (one of the
    ENDINGS before end); at the start of a text it is the end of the one before.
    """
    n = len(bounds) - 1
    now = np.full(len(c) + n, end, np.int64)
    now[np.arange(len(c)) + np.repeat(np.arange(n), np.diff(bounds))] = c
    common = (now < end - ENDINGS) | (now == end)
    last = np.maximum.accumulate(np.where(common, np.arange(len(now)), -1))
    before = np.full(len(now), end, np.int64)
    seen = last[:-1] >= 0
    before[1:][seen] = now[last[:-1][seen]]
    return before, now


#: Dishes of the spelling model: the bytes, and 256 for the end of a word; 256 also stands before its first byte.
SYMBOLS = 257


def spelled(words: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """A key for each byte of the words and each end, and the word that it belongs to. Digits in base SYMBOLS, from the
    least: the byte, the byte before it, and so on for order bytes."""
    sizes = np.array([len(w) for w in words], np.int64)
    ends = np.cumsum(sizes + order + 1) - 1
    s = np.full(int(sizes.sum()) + len(words) * (order + 1), 256, np.int64)
    owner = np.repeat(np.arange(len(words)), sizes + order + 1)
    place = np.arange(len(s)) - np.repeat(ends - sizes - order, sizes + order + 1)  # from 0 in each word
    inside = (place >= order) & (place < np.repeat(sizes, sizes + order + 1) + order)
    s[inside] = np.frombuffer(b"".join(words), np.uint8)
    at = np.flatnonzero(place >= order)
    key = np.zeros(len(at), np.int64)
    for k in range(order, -1, -1):
        key = key * SYMBOLS + s[at - k]
    return key, owner[at]


def spelling_counts(words: DataFrame, order: int) -> DataFrame:
    """key, n of the distinct words (word): one customer of the spelling model for each table of a word."""

    def run(batches):
        import pyarrow as pa

        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for b in batches:
            if b.num_rows:
                key, _ = spelled([w.encode() for w in b.column("word").to_pylist()], order)
                keys, inverse = np.unique(np.concatenate([keys, key]), return_inverse=True)
                counts = np.bincount(inverse, weights=np.concatenate([counts, np.ones(len(key))])).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], ["key", "n"])

    return words.select("word").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


class Spelling:
    """Restaurants for the bytes before a byte, from order of them to none; a context's parent lacks its farthest byte. Here
    they are all in one place; learn_spelling has the same in tasks.

    Kept are, averaged over sweeps, the predictive probability of each dish that a restaurant has and the weight that it
    gives its parent; a dish that it lacks gets that weight times the parent's probability.
    """

    def __init__(self, keys: np.ndarray, counts: np.ndarray, order: int, sweeps: int, burn: int, seed: int, strength: float = 1.0):
        self.order = order
        at = np.argsort(keys)
        level, count = [keys[at]], [counts[at].astype(np.int64)]
        up = []
        for k in range(order, 0, -1):
            parents, index = np.unique(level[0] % SYMBOLS**k, return_inverse=True)
            up.insert(0, index)
            count.insert(0, np.bincount(index, minlength=len(parents)))
            level.insert(0, parents)
        up.insert(0, None)
        context, owner = zip(*[np.unique(x // SYMBOLS, return_inverse=True) for x in level], strict=True)
        tables = [np.minimum(c, 1) for c in count]
        total = lambda x, k: np.bincount(owner[k], weights=x, minlength=len(context[k]))
        mean, back = [np.zeros(len(x)) for x in level], [np.zeros(len(x)) for x in context]

        def predict():
            p, parent = [], 1.0 / SYMBOLS
            for k in range(order + 1):
                customers, t = total(count[k], k), total(tables[k], k)
                weight = (strength + d[k] * t) / (strength + customers)
                parent = np.maximum(count[k] - d[k] * tables[k], 0) / (strength + customers)[owner[k]] + weight[owner[k]] * (parent if k == 0 else p[-1][up[k]])
                p.append(parent)
                weights[k] = weight
            return p

        weights: list = [None] * (order + 1)
        for sweep in range(sweeps):
            d = [discount(c) for c in count]
            p = predict()
            for k in range(order, -1, -1):
                prior = p[k - 1][up[k]] if k else np.full(len(level[0]), 1.0 / SYMBOLS)
                others = total(tables[k], k)[owner[k]] - tables[k]
                tables[k] = seat(count[k], d[k], np.full(len(others), strength), others, prior, Draws(level[k], seed, sweep, k))
                if k:
                    count[k - 1] = np.bincount(up[k], weights=tables[k], minlength=len(level[k - 1])).astype(np.int64)
            if sweep >= burn:
                for k, x in enumerate(predict()):
                    mean[k] += x / (sweeps - burn)
                    back[k] += weights[k] / (sweeps - burn)
        self.level, self.context, self.mean, self.back = level, list(context), mean, back

    @classmethod
    def of(cls, level: list, context: list, mean: list, back: list) -> Spelling:
        """From averages by level, for the contexts of some keys at least."""
        self = cls.__new__(cls)
        self.order, self.level, self.context, self.mean, self.back = len(level) - 1, level, context, mean, back
        return self

    def probabilities(self, key: np.ndarray) -> np.ndarray:
        """P(byte | bytes before) for keys of spelled()."""
        out = np.full(len(key), 1.0 / SYMBOLS)
        left, factor = np.arange(len(key)), np.ones(len(key))
        for k in range(self.order, -1, -1):
            own = key[left] % SYMBOLS ** (k + 1)
            hit, at = _find(self.level[k], own)
            out[left[hit]] = factor[left[hit]] * self.mean[k][at[hit]]
            left, own = left[~hit], own[~hit]
            known, at = _find(self.context[k], own // SYMBOLS)
            factor[left[known]] *= self.back[k][at[known]]
        out[left] = factor[left] / SYMBOLS
        return out

    def __call__(self, words: list[bytes]) -> np.ndarray:
        """log10 probabilities of whole words, their ends included."""
        key, owner = spelled(words, self.order)
        distinct, inverse = np.unique(key, return_inverse=True)
        return np.bincount(owner, weights=np.log10(self.probabilities(distinct))[inverse], minlength=len(words))


def _find(have: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whether each wanted value is in the sorted array, its place)."""
    at = np.searchsorted(have, wanted)
    at[at == len(have)] = 0
    return (have[at] == wanted if len(have) else np.zeros(len(wanted), bool)), at


class Restaurants:
    """Some levels of the spelling model, from low on: the dishes of whole subtrees, their customers and tables."""

    def __init__(self, low: int, keys: list, count: list, tables: list):
        self.keys, self.count, self.tables = list(keys), list(count), list(tables)
        self.context, self.owner = map(list, zip(*[np.unique(x // SYMBOLS, return_inverse=True) for x in keys], strict=True))
        self.up = [None, *(np.searchsorted(a, b % SYMBOLS**k) for k, (a, b) in enumerate(zip(keys[:-1], keys[1:], strict=True), low + 1))]

    @classmethod
    def planted(cls, low: int, order: int, keys: np.ndarray, counts: np.ndarray) -> Restaurants:
        """One table for each dish, from the counts of the level of order (keys sorted)."""
        level, count = [keys], [counts.astype(np.int64)]
        for k in range(order, low, -1):
            parents, n = np.unique(level[0] % SYMBOLS**k, return_counts=True)
            level.insert(0, parents)
            count.insert(0, n.astype(np.int64))
        return cls(low, level, count, [np.minimum(c, 1) for c in count])

    def _total(self, x: np.ndarray, k: int) -> np.ndarray:
        return np.bincount(self.owner[k], weights=x, minlength=len(self.context[k]))

    def predict(self, d: list[float], prior: np.ndarray, strength: float = 1.0) -> tuple[list, list, list]:
        """By level: the parent's probability of each dish, its own, and the weight that its restaurant gives the parent."""
        priors, own, weights = [], [], []
        for k in range(len(self.keys)):
            prior = own[-1][self.up[k]] if k else prior
            customers = strength + self._total(self.count[k], k)[self.owner[k]]
            weight = (strength + d[k] * self._total(self.tables[k], k)[self.owner[k]]) / customers
            priors.append(prior)
            weights.append(weight)
            own.append(np.maximum(self.count[k] - d[k] * self.tables[k], 0) / customers + weight * prior)
        return priors, own, weights

    def seat(self, d: list[float], priors: list, seed: tuple, low: int, strength: float = 1.0) -> None:
        for k in range(len(self.keys) - 1, -1, -1):
            others = self._total(self.tables[k], k)[self.owner[k]] - self.tables[k]
            self.tables[k] = seat(self.count[k], d[k], np.full(len(others), strength), others, priors[k], Draws(self.keys[k], *seed, low + k))
            if k:
                self.count[k - 1] = np.bincount(self.up[k], weights=self.tables[k], minlength=len(self.keys[k - 1])).astype(np.int64)


#: Levels up to here have 257 ** 2 dishes at most and stay on the driver; deeper ones are dealt to tasks.
NEAR = 1
#: A dish of a restaurant: level, key, customers, tables, and sums over sweeps of its probability and its restaurant's weight.
DISHES = "level int, key long, n long, t long, p double, w double"


def _dealt(df: DataFrame, n: int) -> DataFrame:
    """By the two nearest bytes of the context, or by h without a key."""
    return df.repartition(n, F.coalesce(F.expr(f"key div {SYMBOLS} % {SYMBOLS**2}"), F.pmod("h", F.lit(SYMBOLS**2)) if "h" in df.columns else F.lit(None).cast("long")))


def _gather(batches, names) -> list[np.ndarray]:
    """Whole columns of a partition."""
    import pyarrow as pa

    have = [b for b in batches if b.num_rows]
    return [pa.chunked_array([b.column(x) for b in have]).to_numpy().copy() if have else np.zeros(0, np.int64) for x in names]


def _by_level(level, key, *columns, low, order) -> list[list[np.ndarray]]:
    """Each column as a list by level, sorted by key."""
    out = [[] for _ in range(1 + len(columns))]
    for k in range(low, order + 1):
        at = np.flatnonzero(level == k)
        at = at[np.argsort(key[at])]
        for x, c in zip(out, (key, *columns), strict=True):
            x.append(c[at])
    return out


def learn_spelling(words: DataFrame, order: int, sweeps: int, burn: int, seed: int) -> tuple[Spelling, DataFrame | None]:
    """The spelling model of the distinct words: its levels up to NEAR, and the table of dishes of the deeper ones."""
    n, near = partitions(words), min(order, NEAR)
    cells = spelling_counts(words, order)

    def plant(batches):
        import pyarrow as pa

        key, count = _gather(batches, ("key", "n"))
        at = np.argsort(key)
        r = Restaurants.planted(near + 1, order, key[at], count[at])
        for k, (x, c, t) in enumerate(zip(r.keys, r.count, r.tables, strict=True), near + 1):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), k, np.int32)), pa.array(x), pa.array(c), pa.array(t), pa.array(np.zeros(len(x))), pa.array(np.zeros(len(x)))], ["level", "key", "n", "t", "p", "w"])

    def customers(dishes):
        """(key, customers) of the level near."""
        own = dishes.filter(F.col("level") == near + 1).groupBy((F.col("key") % SYMBOLS ** (near + 1)).alias("key")).agg(F.sum("t").alias("n")).toPandas().sort_values("key")
        return own["key"].to_numpy(np.int64), own["n"].to_numpy(np.int64)

    dishes = None
    if order > near:
        dishes = cut(_dealt(cells, n).mapInArrow(plant, DISHES))
        key, count = customers(dishes)
    else:
        own = cells.toPandas().sort_values("key")
        key, count = own["key"].to_numpy(np.int64), own["n"].to_numpy(np.int64)
    low = Restaurants.planted(0, near, key, count)
    mean, back = [np.zeros(len(x)) for x in low.keys], [np.zeros(len(x)) for x in low.keys]
    for sweep in range(sweeps + 1):  # the last only predicts
        d = [discount(x) for x in low.count]
        priors, own, weights = low.predict(d, np.full(len(low.keys[0]), 1.0 / SYMBOLS))
        if sweep > burn:
            mean, back = [a + b for a, b in zip(mean, own, strict=True)], [a + b for a, b in zip(back, weights, strict=True)]
        if dishes is not None:
            dishes = cut(_dealt(dishes, n).mapInArrow(_step(_discounts(dishes, near + 1, order), low.keys[-1], own[-1], near + 1, order, sweep > burn, sweep < sweeps, (seed, sweep)), DISHES))
            low.count[-1] = customers(dishes)[1]
        if sweep < sweeps:
            low.seat(d, priors, (seed, sweep), 0)
    first = [np.searchsorted(x // SYMBOLS, c) for x, c in zip(low.keys, low.context, strict=True)]
    kept = sweeps - burn
    model = Spelling.of(low.keys, low.context, [x / kept for x in mean], [x[f] / kept for x, f in zip(back, first, strict=True)])
    return model, dishes if dishes is None else dishes.select("level", "key", "n", (F.col("p") / kept).alias("p"), (F.col("w") / kept).alias("w"))


def _discounts(dishes: DataFrame, low: int, order: int) -> list[float]:
    """discount() of each level."""
    found = {r["level"]: (r["one"], r["two"]) for r in dishes.groupBy("level").agg(F.count_if(F.col("n") == 1).alias("one"), F.count_if(F.col("n") == 2).alias("two")).collect()}
    pairs = [found.get(k, (0, 0)) for k in range(low, order + 1)]
    return [min(0.95, max(0.05, one / (one + 2 * two))) if one + two else 0.5 for one, two in pairs]


def _step(d, near_keys, near_p, low, order, keep, reseat, seed):
    """A sweep over the restaurants of a task. keep: add up their predictions before it."""

    def run(batches):
        import pyarrow as pa

        columns = _gather(batches, ("level", "key", "n", "t", "p", "w"))
        if not len(columns[0]):
            return
        keys, count, tables, p, w = _by_level(*columns, low=low, order=order)
        r = Restaurants(low, keys, count, tables)
        priors, own, weights = r.predict(d, near_p[np.searchsorted(near_keys, keys[0] % SYMBOLS**low)])
        if reseat:
            r.seat(d, priors, seed, low)
        for k, x in enumerate(keys):
            sums = (p[k] + own[k], w[k] + weights[k]) if keep else (p[k], w[k])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), low + k, np.int32)), pa.array(x), pa.array(r.count[k].astype(np.int64)), pa.array(r.tables[k].astype(np.int64)), *map(pa.array, sums)], ["level", "key", "n", "t", "p", "w"])

    return run


def spell(words: DataFrame, near: Spelling, dishes: DataFrame | None, order: int, common_bits: int) -> DataFrame:
    """h, c, e, logs of words (h, word, n_train, e): e passes through, logs is the log10 probability of the word's spelling.

    The n-grams with at least 1 / 2 ** common_bits of all customers are looked up where the words are; the rest meet the
    table of dishes by a shuffle.
    """
    spark, alone = words.sparkSession, dishes is None
    common_key, common_log = np.zeros(0, np.int64), np.zeros(0)
    if dishes is not None:
        cells = dishes.filter(F.col("level") == order)
        total = cells.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        common = cells.filter(F.col("n") * float(2**common_bits) >= total).select("key", "p").toPandas().sort_values("key")
        common_key, common_log = common["key"].to_numpy(np.int64), np.log10(common["p"].to_numpy())
    shared = spark.sparkContext.broadcast((common_key, common_log, near))
    names = ["h", "c", "e", "level", "key", "p", "w"]
    kind = "h long, c long, e long, level int, key long, p double, w double"

    def looked_up(batches):
        import pyarrow as pa

        common_key, common_log, near = shared.value
        for b in (b.slice(i, 2000) for b in batches for i in range(0, b.num_rows, 2000)):
            key, owner = spelled([w.encode() for w in b.column("word").to_pylist()], order)
            hit, at = _find(common_key, key)
            logs = np.zeros(len(key))
            logs[hit] = common_log[at[hit]]
            if alone:
                logs, hit = np.log10(near.probabilities(key)), np.ones(len(key), bool)
            left, n = owner[~hit], b.num_rows
            word = [b.column("h"), b.column("n_train"), b.column("e"), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()), pa.array(np.bincount(owner, weights=logs, minlength=n)), pa.nulls(n, pa.float64())]
            rest = [b.column("h").take(pa.array(left)), pa.nulls(len(left), pa.int64()), pa.nulls(len(left), pa.int64()), pa.nulls(len(left), pa.int32()), pa.array(key[~hit]), pa.array(np.zeros(len(left))), pa.nulls(len(left), pa.float64())]
            yield pa.RecordBatch.from_arrays(word, names)
            yield pa.RecordBatch.from_arrays(rest, names)

    def met(batches):
        import pyarrow as pa

        near, low = shared.value[2], len(shared.value[2].level)
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        have = pa.Table.from_batches(batches)
        model, asked = have.filter(have["level"].is_valid()), have.filter(have["level"].is_null())
        level, key, p, w = (model[x].to_numpy() for x in ("level", "key", "p", "w"))
        keys, mean, weight = _by_level(level, key, p, w, low=low, order=order)
        found = [np.unique(x // SYMBOLS, return_index=True) for x in keys]
        own = Spelling.of([*near.level, *keys], [*near.context, *(c for c, _ in found)], [*near.mean, *mean], [*near.back, *(x[f] for x, (_, f) in zip(weight, found, strict=True))])
        logs, with_key = asked["p"].to_numpy().copy(), asked["key"].is_valid().to_numpy()
        distinct, inverse = np.unique(asked["key"].drop_null().to_numpy(), return_inverse=True)
        logs[with_key] = np.log10(own.probabilities(distinct))[inverse]
        yield from asked.select(["h", "c", "e"]).append_column("logs", pa.array(logs)).to_batches(max_chunksize=100_000)

    flat = words.select("h", "word", "n_train", "e").mapInArrow(looked_up, kind)
    if dishes is None:
        return flat.select("h", "c", "e", F.col("p").alias("logs"))
    table = dishes.select(*(F.lit(None).cast("long").alias(x) for x in ("h", "c", "e")), "level", "key", "p", "w")
    rows = _dealt(flat.unionByName(table), partitions(words)).mapInArrow(met, "h long, c long, e long, logs double")
    return rows.groupBy("h").agg(F.max("c").alias("c"), F.max("e").alias("e"), F.sum("logs").alias("logs"))


# ---- contexts of words ----

#: Occurrences that a task deals out at once.
DEAL = 1 << 20
#: What goes to a task that seats contexts. whole: numbers and sums of a load's documents, which are only passed on;
#: else n occurrences of n_keys contexts in data. wide: dishes and priors are given themselves, not as places in tables.
LOADS = "part int, load long, whole boolean, wide boolean, n int, n_keys int, data binary, sums binary"
#: What comes back for the documents of a load: their numbers, or which of them have the sums.
ANSWERS = "load long, whole boolean, n int, data binary, sums binary"


def _planes(*arrays: np.ndarray) -> bytes:
    """Arrays as compressed bytes, all first bytes of an array before all second ones."""
    import pyarrow as pa

    return pa.compress(b"".join(x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes() for x in arrays), codec="zstd", asbytes=True)


def _from_planes(data: bytes, *kinds: tuple) -> list[np.ndarray]:
    """The arrays of _planes(); kinds: (dtype, length) of each."""
    import pyarrow as pa

    sizes = [np.dtype(t).itemsize * n for t, n in kinds]
    flat = np.frombuffer(pa.decompress(data, sum(sizes), codec="zstd", asbytes=True), np.uint8)
    cuts = np.cumsum([0, *sizes])
    return [np.ascontiguousarray(flat[i:j].reshape(np.dtype(t).itemsize, n).T).view(t).reshape(n) for (t, n), i, j in zip(kinds, cuts[:-1], cuts[1:], strict=True)]


def places(text, classes: np.ndarray, ending_of: np.ndarray) -> tuple:
    """(words of each text; then for each token, ends included: text, word (the end: 0), context class, class, whether it is
    rare, whether it follows a rare word, its context). The context is the rare word before; after a class or at the start
    of a text it is the class before and the token's own: there, only the choice among rare words of a class is left.
    """
    texts, starts, ends, bounds, h = _tokens(text)
    end = len(classes) + ENDINGS
    before, now = _pairs(_classes(h, classes, ending_of[_ending(texts.data, starts, ends)]), bounds, end)
    sizes = np.diff(bounds)
    word = np.zeros(len(now), np.uint64)
    word[np.arange(len(h)) + np.repeat(np.arange(len(sizes)), sizes)] = h
    rare = (now >= len(classes)) & (now < end)
    follows = np.zeros(len(now), bool)
    follows[1:] = rare[:-1]
    context = (before * (end + 1) + now + 1).astype(np.uint64)
    context[1:][follows[1:]] = word[:-1][follows[1:]]
    return sizes, np.repeat(np.arange(len(sizes)), sizes + 1), word, before, now, rare, follows, mix(context)


def _loads(load: int, n_parts: int, wide: bool, key, dish, prior, doc, train, numbers, sums):
    """Rows of LOADS: the occurrences by the part of their context, and one row for the documents. Only the order of
    the keys is kept as a whole; all columns are fetched part by part, and rows go out by a few."""
    import pyarrow as pa

    kinds = [pa.int32(), pa.int64(), pa.bool_(), pa.bool_(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]

    def out(rows):
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], [x.split()[0] for x in LOADS.split(", ")])

    order = np.argsort(key)
    rows = [(load % n_parts, load, True, wide, numbers.shape[1], 0, _planes(*numbers), _planes(*sums))]
    # the least key of each part; parts share the 2 ** 32 upper halves of keys
    edges = np.searchsorted(key, np.array([-(-(p << 32) // n_parts) << 32 for p in range(n_parts)], np.uint64), sorter=order).tolist()
    for part, (i, j) in enumerate(pairwise([*edges, len(key)])):
        if i == j:
            continue
        at, own = order[i:j], key[order[i:j]]
        first = np.flatnonzero(np.diff(own, prepend=~own[0]))
        times = np.diff(first, append=j - i).astype(np.uint32)
        rows.append((part, load, False, wide, j - i, len(first), _planes(own[first], times, dish[at], prior[at], doc[at].astype(np.uint32), train[at].astype(np.uint8)), None))
        if len(rows) >= 32:
            yield out(rows)
            rows = []
    if rows:
        yield out(rows)


class Pending:
    """Columns that are filled by pieces up to about size rows, in arrays that are used again."""

    def __init__(self, size: int, *kinds):
        self.columns, self.n = [np.empty(size + size // 4, t) for t in kinds], 0

    def add(self, *pieces: np.ndarray) -> None:
        n = self.n + len(pieces[0])
        if n > len(self.columns[0]):  # a text that is longer
            self.columns = [np.concatenate([c[: self.n], np.empty(n - self.n, c.dtype)]) for c in self.columns]
        for c, x in zip(self.columns, pieces, strict=True):
            c[self.n : n] = x
        self.n = n

    def take(self) -> list[np.ndarray]:
        """What was added; valid until more is."""
        n, self.n = self.n, 0
        return [c[:n] for c in self.columns]


def in_context(contexts: np.ndarray, dishes: np.ndarray, context: np.ndarray, dish: np.ndarray, log_prior: np.ndarray, train: np.ndarray, sweeps: int, burn: int, seed: int) -> np.ndarray:
    """log10 P(dish | context) of each occurrence (places in contexts and dishes, log10 of the parent's probability there),
    after seating the customers, which are the occurrences in training text, in a restaurant for each context.

    Each restaurant's discount is that of its own dishes with one and two customers, with one dish more in both cases. The
    parent's probability differs by what stands before the context, so a dish's tables are drawn by its customers' mean.
    """
    if not len(context):
        return np.zeros(0)
    both = context.astype(np.int64) << 32 | dish
    order = np.argsort(both)
    both, prior = both[order], 10.0 ** log_prior[order]
    first = np.flatnonzero(np.diff(both, prepend=-1))
    of = np.repeat(np.arange(len(first)), np.diff(first, append=len(both)))  # dish of each occurrence
    own = both[first]
    at = np.cumsum(np.diff(own >> 32, prepend=own[0] >> 32) != 0)  # restaurant of each dish
    n = np.bincount(of, weights=train[order]).astype(np.int64)
    mean = np.bincount(of, weights=prior * train[order]) / np.maximum(n, 1)
    total = lambda x: np.bincount(at, weights=x)
    one, two, customers = total(n == 1), total(n == 2), total(n)
    d = np.clip((one + 1) / (one + 2 * two + 2), 0.05, 0.95)[at]
    tables, average = np.minimum(n, 1), np.zeros(len(n))
    many = np.flatnonzero(n > 1)
    draws = mix(contexts[own[many] >> 32] + dishes[own[many] & 0xFFFFFFFF] * np.uint64(0x9DDFEA08EB382D69)).view(np.int64)
    for sweep in range(sweeps):
        others = total(tables)[at[many]] - tables[many]
        tables[many] = seat(n[many], d[many], np.ones(len(many)), others, mean[many], Draws(draws, seed, sweep, 98))
        if sweep >= burn:
            average += tables / (sweeps - burn)
    kept = np.maximum(n - d * average, 0) / (1 + customers[at])
    back = (1 + d * total(average)[at]) / (1 + customers[at])
    out = np.empty(len(both))
    with np.errstate(divide="ignore"):
        out[order] = np.log10(kept[of] + back[of] * prior)
    new = order[kept[of] == 0]  # a prior may be too small for a double
    out[new] = np.log10(back[of[kept[of] == 0]]) + log_prior[new]
    return out


def in_ranges(contexts: np.ndarray, dishes: np.ndarray, context: np.ndarray, dish: np.ndarray, log_prior: np.ndarray, train: np.ndarray, doc: np.ndarray, sweeps: int, burn: int, seed: int, most: int = 0) -> np.ndarray:
    """Sums of in_context() by doc, 0, 1, ...; restaurants are seated by ranges with most occurrences each (or one context)."""
    order, most = np.argsort(context, kind="stable"), most or DEAL // 4
    ordered = context[order]
    edges = np.unique(np.searchsorted(ordered, ordered[most::most]))  # a range begins where a context does
    sums = np.zeros(int(doc.max(initial=-1)) + 1)
    for i, j in pairwise(np.unique([0, *edges, len(order)]).tolist()):
        at = order[i:j]
        sums += np.bincount(doc[at], weights=in_context(contexts, dishes, ordered[i:j], dish[at], log_prior[at], train[at], sweeps, burn, seed), minlength=len(sums))
    return sums


def key_ranges(keys: list, times: list, most: int) -> np.ndarray:
    """The first keys of all ranges but the least: a range has most occurrences or a few more, or one key that has more.
    keys, times: the contexts of each load and their occurrences."""
    key = np.concatenate(keys)
    order = np.argsort(key)
    key, so_far = key[order], np.cumsum(np.concatenate(times)[order], dtype=np.int64)
    return np.unique(key[np.searchsorted(so_far, np.arange(most, so_far[-1], most), side="right")])


def seated(loads: DataFrame, n_parts: int, tables, sweeps: int, burn: int, seed: int) -> DataFrame:
    """ANSWERS to LOADS: a task has all occurrences of its contexts. It keeps them by load as they came (in order of their
    contexts), and puts together those of a range of contexts at a time."""

    def run(batches):
        import pyarrow as pa

        common_h, common_score, common_class, log_pairs = tables.value[:4]
        have, others, n_docs = [], [np.zeros(0, np.uint64)], 0
        names = [x.split()[0] for x in ANSWERS.split(", ")]
        for b in batches:
            whole = b.filter(b.column("whole"))
            if whole.num_rows:
                yield whole.select(names)
            for i in np.flatnonzero(~b.column("whole").to_numpy(zero_copy_only=False)).tolist():
                load, wide, n, n_keys = (b.column(x)[i].as_py() for x in ("load", "wide", "n", "n_keys"))
                kinds = ("u8", n), ("f8", n)
                key, times, dish, prior, doc, train = _from_planes(b.column("data")[i].as_buffer(), ("u8", n_keys), ("u4", n_keys), *(kinds if wide else (("i4", n), ("i4", n))), ("u4", n), ("u1", n))
                if wide:
                    own, dish = np.unique(dish, return_inverse=True)
                    others.append(own)
                docs, doc = np.unique(doc, return_inverse=True)
                have.append([load, docs, key, times, len(others) - 1 if wide else 0, dish.astype(np.int32), prior, (doc + n_docs).astype(np.int32), train.astype(bool)])  # a copy: single bytes are a view of all that was unpacked
                n_docs += len(docs)
        if not have:
            return
        sums, most = np.zeros(n_docs), DEAL // 4
        wide_h = np.unique(np.concatenate(others))
        for x in have:
            if x[4]:
                x[5] = (len(common_h) + np.searchsorted(wide_h, others[x[4]])).astype(np.int32)[x[5]]
        dishes = np.append(common_h, wide_h)
        edges = key_ranges([x[2] for x in have], [x[3] for x in have], most)
        at = [np.concatenate([[0], np.searchsorted(x[2], edges), [len(x[2])]]) for x in have]  # the ranges' contexts in each load
        ends = [np.concatenate([[0], np.cumsum(x[3], dtype=np.int64)]) for x in have]
        for r in range(len(edges) + 1):
            keys, pieces = [], []
            for (_, _, key, times, wide, *columns), own, end in zip(have, at, ends, strict=True):
                i, j = own[r], own[r + 1]
                if i == j:
                    continue
                dish, prior, doc, train = (c[end[i] : end[j]] for c in columns)
                keys.append((key[i:j], times[i:j]))
                pieces.append((dish, prior if wide else log_pairs[prior, common_class[dish]] + common_score[dish], doc, train))
            key, times = map(np.concatenate, zip(*keys, strict=True))
            contexts, place = np.unique(key, return_inverse=True)
            dish, prior, doc, train = map(np.concatenate, zip(*pieces, strict=True))
            own = in_ranges(contexts, dishes, np.repeat(place.astype(np.int32), times), dish, prior, train, doc, sweeps, burn, seed)
            sums[: len(own)] += own
        end = 0
        for load, docs, *_ in have:
            row = load, False, len(docs), _planes(docs), sums[end : end + len(docs)].tobytes()
            end += len(docs)
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, (pa.int64(), pa.bool_(), pa.int32(), pa.binary(), pa.binary()), strict=True)], names)

    return loads.repartitionById(n_parts, "part").mapInArrow(_released(run), ANSWERS)


def added_up(answers: DataFrame) -> DataFrame:
    """doc, n_tokens, n_known, base, points of the documents of each load."""

    def run(batches):
        import pyarrow as pa

        numbers, base, points = {}, {}, {}
        for r in (r for b in batches for r in b.to_pylist()):
            load, n = r["load"], r["n"]
            if r["whole"]:
                numbers[load] = _from_planes(r["data"], *[("i8", n)] * 3)
                base[load], own = _from_planes(r["sums"], *[("f8", n)] * 2)
                docs = np.arange(n)
            else:
                (docs,), own = _from_planes(r["data"], ("u4", n)), np.frombuffer(r["sums"])
            points.setdefault(load, []).append((docs, own))
        for load, (doc, n_tokens, n_known) in numbers.items():
            docs, own = (np.concatenate(x) for x in zip(*points.pop(load), strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (doc, n_tokens, n_known, base[load], np.bincount(docs, weights=own, minlength=len(doc)))], ["doc", "n_tokens", "n_known", "base", "points"])

    return answers.repartition(partitions(answers), "load").mapInArrow(run, "doc long, n_tokens long, n_known long, base double, points double")


# ---- the operator ----


def _least(vocabulary: DataFrame, most: int) -> int:
    """The least count of training tokens, 1 or more, that no more than most words reach."""
    have = vocabulary.filter("n_train > 0").groupBy("n_train").agg(F.count(F.lit(1)).alias("words")).toPandas().sort_values("n_train", ascending=False)  # different counts only
    over = have["n_train"][have["words"].cumsum() > most]
    return int(over.iloc[0]) + 1 if len(over) else 1


def score(docs: DataFrame, class_bits: int = 11, common_bits: int = 20, spelling_order: int = 4, sweeps: int = 8, burn: int = 4, seed: int = 1) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of each document.

    common_bits: the 2 ** common_bits words with most training tokens (fewer where counts tie) are looked up in tasks; the
    rest by a join. So are spelling n-grams, with at least 1 / 2 ** common_bits of all customers (see spell).
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held"), F.xxhash64("doc_id", "text").alias("doc"))
    vocabulary = cut(word_counts(docs))
    ends = docs.filter("NOT held").count()
    words, distinct = vocabulary.filter("n_train > 0").agg(F.coalesce(F.sum("n_train"), F.lit(0)), F.count(F.lit(1))).first()
    total, different = words + ends, distinct + (ends > 0)
    base = lambda c: np.log10((c + 0.5) / (total + 0.5 * (different + 1)))

    is_class = F.col("n_train") * float(2**class_bits) >= max(1, total)
    least = _least(vocabulary, 2**common_bits)
    common = vocabulary.filter((F.col("n_train") >= least) | is_class).select("h", "n_train").toArrow()
    common_h, common_n = common["h"].to_numpy().view(np.uint64), common["n_train"].to_numpy()
    common_h, common_n = common_h[np.argsort(common_h)], common_n[np.argsort(common_h)]
    classes = common_h[common_n * 2**class_bits >= max(1, total)]
    rare = vocabulary.filter(~is_class)
    learnt = rare.filter("n_train > 0")
    ending_of, types, mass = endings(learnt)
    k = len(classes) + ENDINGS + 1
    pairs = fit(class_counts(docs, classes, ending_of), sweeps, burn, seed)
    near, dishes = learn_spelling(learnt, spelling_order, sweeps, burn, seed)
    one, two = learnt.agg(F.count_if(F.col("n_train") == 1), F.count_if(F.col("n_train") == 2)).first()
    d = min(0.95, max(0.05, one / (one + 2 * two))) if one + two else 0.5
    last = F.conv(F.hex(F.substring(F.encode("word", "utf-8"), -2, 2)), 16, 10).cast("long")
    logs = spell(rare.withColumn("e", last), near, dishes, spelling_order, common_bits)

    def rated(batches):
        import pyarrow as pa

        for b in batches:
            count, e, logs = (b.column(x).to_numpy() for x in ("c", "e", "logs"))
            e = ending_of[e]
            # the share of spellings with the word's ending is that of the types which the spelling model has learnt from
            logs = logs + np.log10(types.sum() / types[e])
            prior, new = 10.0**logs, (1 + d * types[e]) / (1 + mass[e])
            average = np.zeros(len(count))
            words = b.column("h").to_numpy()
            for r in range(sweeps - burn):  # seatings of the restaurants of rare words; other dishes have a table or more
                t = seat(count, d, np.ones(len(count)), types[e], prior, Draws(words, seed, r, 99))
                average += np.maximum(count - d * t, 0) / (1 + mass[e]) + new * prior
            own = np.log10(np.maximum(average / (sweeps - burn), 1e-300))
            own = np.where(average > 0, own, logs + np.log10(new))  # a word too long for a double
            yield pa.RecordBatch.from_arrays([b.column("h"), b.column("c"), pa.array(e), pa.array(base(count)), pa.array(own)], ["h", "c", "e", "word_base", "word_score"])

    rated_words = cut(logs.sortWithinPartitions("h").mapInArrow(rated, "h long, c long, e long, word_base double, word_score double"))
    # common words that are no class: their scores, bounded like the words themselves
    lookup = rated_words.filter(F.col("c") >= least).select("h", "e", "word_score").toArrow()
    at = np.searchsorted(common_h, lookup["h"].to_numpy().view(np.uint64))
    common_score, common_class = np.zeros(len(common_h) + 1), np.full(len(common_h) + 1, k - 1, np.int32)  # the last is the end of a text
    common_score[at], common_class[at] = lookup["word_score"].to_numpy(), len(classes) + lookup["e"].to_numpy()
    common_class[np.searchsorted(common_h, classes)] = np.arange(len(classes))
    log_pairs = np.vstack([np.log10(pairs), np.zeros(k)])  # the last context: the class is given
    tables = spark.sparkContext.broadcast((np.append(common_h, np.uint64(0)), common_score, common_class, log_pairs, common_n, classes, ending_of, float(base(np.int64(ends)))))
    n_parts = 2 * partitions(docs)

    def found(word, common_h):
        """(whether each token is a common word or an end, its place)."""
        different, inverse = np.unique(word, return_inverse=True)
        at = np.searchsorted(common_h[:-1], different)
        at[different == 0] = len(common_h) - 1
        return (common_h[at] == different)[inverse], at[inverse]

    def dealt(batches):
        """Occurrences of common words and ends, and the documents."""
        from pyspark import TaskContext

        common_h, _, _, log_pairs, common_n, classes, ending_of, end_base = tables.value
        have, seen, n_docs, load = Pending(DEAL, np.uint64, np.int32, np.int32, np.uint32, bool), [], 0, TaskContext.get().partitionId() << 32

        def flushed():
            yield from _loads(load, n_parts, False, *have.take(), np.concatenate([x[0] for x in seen], axis=1), np.concatenate([x[1] for x in seen], axis=1))

        for b in (p for batch in batches for p in parts(batch, limit=SLICE)):
            sizes, text, word, before, now, rare, follows, context = places(b.column("text"), classes, ending_of)
            n, (hit, at) = len(sizes), found(word, common_h)
            is_word = hit & (at < len(common_h) - 1)
            points = np.bincount(text[~follows], weights=log_pairs[before[~follows], now[~follows]], minlength=n)
            count = common_n[at[is_word]]
            plain = np.bincount(text[is_word], weights=base(count), minlength=n) + end_base
            known = np.bincount(text[is_word], weights=count > 0, minlength=n).astype(np.int64) + (ends > 0)
            asked = np.flatnonzero(hit & (rare | follows))
            train = ~np.array(b.column("held").to_pylist(), bool)
            have.add(context[asked], at[asked], np.where(follows[asked], before[asked], k), text[asked] + n_docs, train[text[asked]])
            seen.append((np.stack([b.column("doc").to_numpy(), sizes + 1, known]), np.stack([plain, points])))
            n_docs += n
            if have.n >= DEAL or n_docs >= DEAL:
                yield from flushed()
                seen, n_docs, load = [], 0, load + 1
        if seen:
            yield from flushed()

    def others(batches):
        """A row for each occurrence of a word that is not common."""
        import pyarrow as pa

        common_h, _, _, log_pairs, _, classes, ending_of, _ = tables.value
        for b in (p for batch in batches for p in parts(batch, limit=SLICE)):
            _, text, word, before, now, _, follows, context = places(b.column("text"), classes, ending_of)
            at = np.flatnonzero(~found(word, common_h)[0])
            of = pa.array(text[at])
            yield pa.RecordBatch.from_arrays([pa.array(word[at].view(np.int64)), b.column("doc").take(of), b.column("held").take(of), pa.array(context[at].view(np.int64)), pa.array(log_pairs[np.where(follows[at], before[at], k), now[at]])], ["h", "doc", "held", "context", "prior"])

    def rated_others(batches):
        from pyspark import TaskContext

        load, most = 1 << 62 | TaskContext.get().partitionId() << 32, DEAL // 4  # their rows are wider
        have = Pending(most, np.uint64, np.uint64, np.float64, np.int64, bool, bool, np.float64)

        def flushed():
            context, h, prior, doc, train, known, plain = have.take()
            own_docs, at = np.unique(doc, return_inverse=True)
            zero = np.zeros(len(own_docs))
            numbers = np.stack([own_docs, zero.astype(np.int64), np.bincount(at, weights=known).astype(np.int64)])
            yield from _loads(load, n_parts, True, context, h, prior, at, train, numbers, np.stack([np.bincount(at, weights=plain), zero]))

        for b in (b.slice(i, most // 4) for b in batches for i in range(0, b.num_rows, most // 4)):
            h, doc, held, context, prior, c, plain, own = (b.column(x).to_numpy(zero_copy_only=False) for x in ("h", "doc", "held", "context", "prior", "c", "word_base", "word_score"))
            have.add(context.view(np.uint64), h.view(np.uint64), prior + own, doc, ~held, c > 0, plain)
            if have.n >= most:
                yield from flushed()
                load += 1
        if have.n:
            yield from flushed()

    rest = docs.select("text", "held", "doc").mapInArrow(_released(others), "h long, doc long, held boolean, context long, prior double").join(rated_words.drop("e"), "h")
    rest = rest.sortWithinPartitions("doc", "h", "context", "prior")  # loads are the same if a task runs again
    loads = docs.select("text", "held", "doc").mapInArrow(_released(dealt), LOADS).unionByName(rest.mapInArrow(_released(rated_others), LOADS))
    sums = added_up(seated(loads, n_parts, tables, sweeps, burn, seed)).groupBy("doc").agg(
        F.count_if(F.col("n_tokens") > 0).alias("rows"),  # equal rows are added up
        *(F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base", "points")),
    )
    whole = lambda c: F.expr(f"{c} DIV rows").alias(c)
    return docs.select("doc_id", "held", "doc").join(sums, "doc").select("doc_id", F.col("held").alias("held_out"), whole("n_tokens"), whole("n_known"), F.lit(total).cast("long").alias("train_tokens"), (F.col("base") / F.col("rows")).alias("base_score"), (F.col("points") / F.col("rows")).alias("score"))
