"""MinHash near-dedup with tensored bands.

A document's set is hashed into two small collections of half-bands (halves each, of rows minhashes). Table keys are the
pairs of one half from each: halves * halves tables from 2 * halves * rows minhashes. Two sets with Jaccard 0.8 share no
table with probability 2 * 0.36 ** 14 = 1.2e-6.

Equal sets are one class from the start. The tables are used in two rounds. First those on the diagonal (halves of equal
place): all members of one are verified on their full sets against the one that meets most others, so groups of near copies
cost one pair a member instead of all pairs. Then all tables, for the components that this leaves: only halves that stand
in several components are expanded by the second collection, and a component counts once a table. There one document of
each component meets the table's centre. Where a table still holds several, their documents meet on their rarest shingles, an exact condition for the threshold, and only those
pairs are verified. So no link between classes that meet in a table is lost.
Everything is a join or an aggregation that combines before it shuffles.

Null and empty texts have empty sets, link with nothing and are kept. Rows without doc_id link with nothing: null
component, kept. Rows that repeat a doc_id are one document as to links. Other columns pass through unread.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Batch, cut, mix, ngram_hash, parts, word_hashes


#: Bits of a set's parity bitmap.
BITS = 1024


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text's word hashes; fewer words than width make one shingle."""
    if 0 < len(words) < width:
        return ngram_hash(words, len(words)) ^ np.uint64(len(words))
    return np.unique(ngram_hash(words, width))


def signatures(docs: DataFrame, width: int, halves: int, rows: int) -> DataFrame:
    """doc_id, n_shingles, f1, f2 (fingerprint of the set), mins (2 * halves * rows minhashes, none for an empty set), bits."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    k = 2 * halves * rows
    mult = np.random.default_rng(51).integers(1, 2**63, k, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def run(batches):
        import pyarrow as pa

        for b in (p for batch in batches for p in parts(batch)):
            words, bounds = word_hashes(Batch(b.column("text")))
            sets = [shingles(words[i:j], width) for i, j in zip(bounds[:-1], bounds[1:], strict=True)]
            n = np.array([len(s) for s in sets], np.int64)
            full = np.flatnonzero(n)
            mins = np.zeros((len(full), k), np.int32)
            f = np.zeros((2, b.num_rows), np.int64)
            parity = np.zeros((len(full), BITS), np.uint8)
            if len(full):
                flat = np.concatenate([sets[i] for i in full])
                at = np.concatenate([[0], np.cumsum(n[full])[:-1]])
                for c in range(k):
                    mins[:, c] = (np.minimum.reduceat(flat * mult[c] ^ (flat >> np.uint64(29)) * mult[c - 1], at) >> np.uint64(32)).astype(np.uint32).view(np.int32)
                np.bitwise_xor.at(parity, (np.repeat(np.arange(len(full)), n[full]), (flat & np.uint64(BITS - 1)).astype(np.int64)), 1)
                f[0, full] = np.add.reduceat(mix(flat ^ np.uint64(0xA5A5)), at).view(np.int64)
                f[1, full] = np.bitwise_xor.reduceat(mix(flat + np.uint64(77)), at).view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum((n > 0) * k)]).astype(np.int32)), pa.array(mins.reshape(-1)))
            packed = pa.array(np.packbits(parity, axis=1).view(np.int64).reshape(-1))
            bits = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum((n > 0) * (BITS // 64))]).astype(np.int32)), packed)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n), pa.array(f[0]), pa.array(f[1]), lists, bits], ["doc_id", "n_shingles", "f1", "f2", "mins", "bits"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_shingles long, f1 long, f2 long, mins array<int>, bits array<long>")


def near_enough(x: str, y: str, percent: int) -> Column:
    """Whether two sets can be at the threshold: each shingle flips one of BITS bits, so the bits in which the sets differ
    are at most the shingles in which they do. x, y: prefixes of columns n and bits."""
    n = F.col(f"{x}n") + F.col(f"{y}n")
    differ = sum(F.bit_count(F.get(f"{x}bits", F.lit(k)).bitwiseXOR(F.get(f"{y}bits", F.lit(k)))) for k in range(BITS // 64))
    fits = F.least(f"{x}n", f"{y}n") * 100 >= F.greatest(f"{x}n", f"{y}n") * percent
    return fits & (differ * (100 + percent) <= n * (100 - percent))


def _halves(first: int, halves: int, rows: int) -> Column:
    return F.array(*[F.xxhash64(F.lit(h), *[F.col("mins")[h * rows + r] for r in range(rows)]) for h in range(first, first + halves)])


def _both(halves: int, rows: int) -> list[Column]:
    return [_halves(0, halves, rows).alias("a"), _halves(halves, halves, rows).alias("b")]


def diagonal(classes: DataFrame, halves: int, rows: int) -> DataFrame:
    """t, x, weight: the members x of the tables of two or more among those that pair the halves of equal place; tables with
    the same members count once. weight: members times the tables with the same ones."""
    pairs = F.arrays_zip(*_both(halves, rows))
    keyed = classes.select(F.col("rep").alias("x"), F.explode(pairs).alias("h")).select("x", F.xxhash64("h.a", "h.b").alias("t"))
    each = keyed.groupBy("t").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("x")).alias("h1"), F.bit_xor(F.xxhash64(F.lit(9), "x")).alias("h2"))
    distinct = each.filter("n > 1").groupBy("n", "h1", "h2").agg(F.min("t").alias("t"), (F.count(F.lit(1)) * F.col("n")).alias("weight")).select("t", "weight")
    return keyed.join(distinct, "t")


def tables(placed: DataFrame) -> DataFrame:
    """t, x, comp: the members x of all tables whose first half stands in several components, from placed (x, comp, a, b).
    A table of several components has such a half, so it is here whole; a component that meets no other has no row."""
    first = placed.select("x", "comp", F.explode("a").alias("a"))
    between = first.groupBy("a").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi").select("a")
    return first.join(between, "a").join(placed.select("x", "b"), "x").select("x", "comp", "a", F.explode("b").alias("b")).select("x", "comp", F.xxhash64("a", "b").alias("t"))


def stars(members: DataFrame, most: int) -> DataFrame:
    """x, y: each member beside the member of its table that meets most others over all tables: copies beside what they are
    copies of. A member takes part in the `most` tables of greatest weight; what stars leave unlinked, alone() and rare_pairs() find.
    """
    meets = members.groupBy("x").agg(F.sum("weight").alias("meets"))
    best = members.withColumn("k", F.row_number().over(W.partitionBy("x").orderBy(F.col("weight").desc(), "t"))).filter(F.col("k") <= most)
    best = best.join(meets, "x").select("t", "x", "meets")
    centre = best.groupBy("t").agg(F.max_by("x", F.struct("meets", F.col("x"))).alias("y"))
    return best.join(centre, "t").filter("x <> y").select("x", "y").distinct()


def verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (x, y) with 100 * intersection >= percent * union of their full sets."""
    joined = pairs.join(texts.select(F.col("doc_id").alias("x"), F.col("text").alias("tx")), "x")
    joined = joined.join(texts.select(F.col("doc_id").alias("y"), F.col("text").alias("ty")), "y")
    kind = texts.schema["doc_id"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        for b in (p for batch in batches for p in parts(batch, "tx")):
            ids = b.column("y").to_pylist()
            firsts = [i for i, v in enumerate(ids) if i == 0 or v != ids[i - 1]]
            left, lb = word_hashes(Batch(b.column("tx")))
            right, rb = word_hashes(Batch(b.column("ty").take(pa.array(firsts, pa.int64()))))
            keep, k, mine = [], -1, None
            for i in range(b.num_rows):
                if k + 1 < len(firsts) and firsts[k + 1] == i:
                    k += 1
                    mine = shingles(right[rb[k] : rb[k + 1]], width)
                other = shingles(left[lb[i] : lb[i + 1]], width)
                both = len(np.intersect1d(mine, other, assume_unique=True))
                keep.append(both > 0 and 100 * both >= percent * (len(mine) + len(other) - both))
            yield pa.RecordBatch.from_arrays([b.column("x"), b.column("y")], ["x", "y"]).filter(pa.array(keep, pa.bool_()))

    return joined.mapInArrow(run, f"x {kind}, y {kind}").distinct()


def fetched(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of docs (doc_id, ...) whose doc_id is in ids. Always by a shuffle with a hash table of ids in each partition:
    ids grow with the corpus, and the texts need no sorting."""
    return docs.join(ids.hint("shuffle_hash"), "doc_id", "left_semi")


def meetings(keyed: DataFrame) -> DataFrame:
    """t, comp, n, x, y: how many rows of keyed (t, x, comp) a component has in a table, and its smallest and largest x. One row
    however many copies a component holds, so a large group doesn't come back once a document and table."""
    return keyed.groupBy("t", "comp").agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("x"), F.max("x").alias("y"))


def _open(met: DataFrame) -> DataFrame:
    """t, n, x, y of the tables of met (from meetings()) in which several components stand."""
    each = met.groupBy("t").agg(F.sum("n").alias("n"), F.min("x").alias("x"), F.max("y").alias("y"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    return each.filter("lo < hi")


def meetings_of(met: DataFrame, placed: DataFrame) -> DataFrame:
    """met again, for the open tables, with the present components of placed (x, comp)."""
    now = placed.select("x", F.col("comp").alias("now"))
    rows = met.join(_open(met).select("t"), "t", "left_semi").join(now, "x")
    return rows.groupBy("t", F.col("now").alias("comp")).agg(F.sum("n").alias("n"), F.min("x").alias("x"), F.max("y").alias("y"))


def leaders(met: DataFrame) -> DataFrame:
    """t, x, weight for stars(): in each open table one document of each component; weight: the table's members."""
    return met.join(_open(met).select("t", F.col("n").alias("weight")), "t").select("t", "x", "weight")


def joined_up(placed: DataFrame, links: DataFrame) -> DataFrame:
    """placed (x, ...) with comp, the smallest x that links reach."""
    labels = components(links).withColumnRenamed("node", "x")
    return placed.drop("comp").join(labels, "x", "left").withColumn("comp", F.coalesce("comp", "x"))


def open_members(met: DataFrame, placed: DataFrame) -> DataFrame:
    """The rows of placed (comp, ...) whose component meets another in a table of more than two; tables of two are alone()."""
    comps = met.join(_open(met).filter("n > 2").select("t"), "t").select("comp").distinct()
    return placed.join(comps, "comp", "left_semi")


def alone(met: DataFrame) -> DataFrame:
    """x, y (x < y) of different components that have a table for themselves: no third member can have been their centre."""
    return _open(met).filter("n = 2").select("x", "y").distinct()


def twosomes(members: DataFrame, placed: DataFrame) -> DataFrame:
    """alone() for members (t, x) and placed (doc_id, comp)."""
    return alone(meetings(members.join(placed.select(F.col("doc_id").alias("x"), "comp"), "x")))


def rare_pairs(texts: DataFrame, sizes: DataFrame, width: int, percent: int) -> DataFrame:
    """x, y of different comp, among the documents of sizes (doc_id, n, comp), that share a rare shingle where every pair at
    the threshold must: the rarest shingles of a set come first, and similar sets agree on one of the first few.

    Shingles whose holders are all of one component can't be shared by such a pair; they count as the rarest and are
    dropped before anything is joined. A pair with the larger set x has an intersection of percent of n(x) at least, so x
    can miss that many shingles less one before one must be in y; and y likewise, with 2 t / (1 + t) of its own size.
    Components meet first, then the documents of two of them, so that documents of one component never face each other.
    """
    kind = texts.schema["doc_id"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        for b in (p for batch in batches for p in parts(batch)):
            words, bounds = word_hashes(Batch(b.column("text")))
            sets = [shingles(words[i:j], width) for i, j in zip(bounds[:-1], bounds[1:], strict=True)]
            at = pa.array(np.repeat(np.arange(b.num_rows), [len(s) for s in sets]))
            yield pa.RecordBatch.from_arrays([b.column("doc_id").take(at), b.column("comp").take(at), pa.array(np.concatenate(sets).view(np.int64))], ["doc_id", "comp", "s"])

    held = texts.join(sizes.select("doc_id", "comp").hint("shuffle_hash"), "doc_id").select("doc_id", "text", "comp").mapInArrow(run, f"doc_id {kind}, comp {kind}, s long")
    often = held.groupBy("s").agg(F.count(F.lit(1)).alias("df"), F.min("comp").alias("a"), F.max("comp").alias("z")).filter("a < z").select("s", "df")
    shared = held.select("doc_id", "s").join(often, "s").join(sizes, "doc_id")
    w = W.partitionBy("doc_id")
    ranked = shared.withColumn("k", F.row_number().over(w.orderBy("df", "s")) + F.col("n") - F.count(F.lit(1)).over(w))
    need = lambda n, a, b: F.floor((n * a + b - 1) / b)  # noqa: E731  ceil(n * a / b)
    probe = cut(ranked.filter(F.col("k") <= F.col("n") - need(F.col("n"), percent, 100) + 1).select("s", "doc_id", "n", "k", "comp"))
    index = probe.filter(F.col("k") <= F.col("n") - need(F.col("n"), 2 * percent, 100 + percent) + 1)
    x, y = (df.select("s", *[F.col(c).alias(f"{p}{c}") for c in ("doc_id", "n", "k", "comp")]) for df, p in ((probe, "x"), (index, "y")))
    comps = x.select("s", "xcomp").distinct().join(y.select("s", "ycomp").distinct(), "s").filter("xcomp <> ycomp")
    larger = (F.col("yn") < F.col("xn")) | ((F.col("yn") == F.col("xn")) & (F.col("ydoc_id") < F.col("xdoc_id")))
    # what is left from the first common shingle on must reach the intersection that the threshold asks for
    reach = (F.least(F.col("xn") - F.col("xk"), F.col("yn") - F.col("yk")) + 1) * (100 + percent) >= (F.col("xn") + F.col("yn")) * percent
    pairs = comps.join(x, ["s", "xcomp"]).join(y, ["s", "ycomp"]).filter(larger & reach & (F.col("yn") * 100 >= F.col("xn") * percent))
    return pairs.select(F.col("xdoc_id").alias("x"), F.col("ydoc_id").alias("y")).distinct()


def like_enough(pairs: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """The pairs (x, y) that sizes and bitmaps of known (doc_id, n, bits) don't rule out."""
    one, two = (known.select(*[F.col(c).alias(f"{p}{c}") for c in known.columns]) for p in ("x", "y"))
    both = pairs.join(one, F.col("x") == F.col("xdoc_id")).join(two, F.col("y") == F.col("ydoc_id"))
    return both.filter(near_enough("x", "y", percent)).select("x", "y")


def components(links: DataFrame) -> DataFrame:
    """node, comp (smallest node reachable) for the nodes of links (x, y): labels hop along links and along labels."""
    both = cut(links.select("x", "y").union(links.select("y", "x")).distinct())
    labels = cut(both.groupBy(F.col("x").alias("node")).agg(F.least(F.min("y"), F.col("node")).alias("comp")))
    while True:
        near = both.join(labels.select(F.col("node").alias("y"), "comp"), "y").groupBy(F.col("x").alias("node")).agg(F.min("comp").alias("best"))
        step = labels.join(near, "node").select("node", F.col("comp").alias("was"), F.least("comp", "best").alias("comp"))
        hop = labels.select(F.col("node").alias("comp"), F.col("comp").alias("root"))
        step = cut(step.join(hop, "comp").select("node", "was", F.col("root").alias("comp")))
        labels = step.select("node", "comp")
        if step.filter("was <> comp").isEmpty():
            return labels


def linked(pairs: DataFrame, known: DataFrame, texts: Callable[[DataFrame], DataFrame], width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The pairs that sizes and bitmaps leave, and the links among them. texts gives doc_id and text for a table of doc_id."""
    pairs = cut(pairs)
    tried = cut(like_enough(pairs, fetched(known, _ends(pairs)), percent))
    return tried, cut(verified(tried, texts(_ends(tried)), width, percent))


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("x", "y")).alias("doc_id")).distinct()


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, halves: int = 14, rows: int = 2) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of docs."""
    signed = cut(signatures(docs, width, halves, rows))
    full = signed.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    own = ["n_shingles", "f1", "f2"]
    classes = cut(full.groupBy(*own).agg(F.min("doc_id").alias("rep"), F.first("mins").alias("mins"), F.first("bits").alias("bits")))
    known = classes.select(F.col("rep").alias("doc_id"), F.col("n_shingles").alias("n"), "bits")
    texts = docs.select("doc_id", "text")
    tried, links = linked(stars(cut(diagonal(classes, halves, rows)), halves), known, lambda ids: cut(fetched(texts, ids)), width, percent)
    placed = cut(joined_up(classes.select(F.col("rep").alias("x"), F.col("n_shingles").alias("n"), *_both(halves, rows)), links))
    met = cut(meetings(tables(placed)))
    again = _ordered(stars(leaders(met), halves)).join(_ordered(tried), ["x", "y"], "left_anti")
    once, more = linked(again, known, lambda ids: cut(fetched(texts, ids)), width, percent)
    tried, links = _ordered(tried).union(once), cut(links.union(more))
    placed = cut(joined_up(placed, links))
    met = cut(meetings_of(met, placed))
    sizes = cut(open_members(met, placed.select(F.col("x").alias("doc_id"), "n", "comp")))
    pairs = cut(alone(met))
    open_texts = cut(fetched(texts, sizes.select("doc_id").union(_ends(pairs)).distinct()))
    rest = _ordered(rare_pairs(fetched(open_texts, sizes.select("doc_id")), sizes, width, percent).union(pairs))
    _, more = linked(rest.join(_ordered(tried), ["x", "y"], "left_anti"), known, lambda _: open_texts, width, percent)
    labels = components(cut(links.union(more).union(_shared_ids(full, own))))
    found = classes.select(*own, "rep").join(labels, F.col("rep") == F.col("node"), "left").select(*own, F.coalesce("comp", "rep").alias("component"))
    out = signed.drop("mins", "bits").join(found, own, "left")
    out = out.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")))
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def _shared_ids(full: DataFrame, own: list[str]) -> DataFrame:
    """Links between the representatives of classes that hold the same doc_id."""
    reps = full.groupBy(*own).agg(F.min("doc_id").alias("rep"))
    twice = full.groupBy("doc_id").agg(F.count_distinct(*own).alias("n")).filter("n > 1").select("doc_id")
    held = full.join(twice, "doc_id").join(reps, own).select("doc_id", F.col("rep").alias("y")).distinct()
    first = held.groupBy("doc_id").agg(F.min("y").alias("x"))
    return held.join(first, "doc_id").filter("x <> y").select("x", "y")


def near_dedup(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs that stay, one document of each group, with the columns of docs."""
    kept = near_duplicates(docs, **options).filter("kept").select("doc_id").distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["doc_id"]), "left_semi")
