"""Quality rules: a short-circuit cascade whose order is fitted on a sample.

Every rule is a Column that is true where it rejects a text. The cascade is one CASE expression over the words of the text,
which are split once: a rule, and the metrics that it alone asks for, are evaluated only for rows that no earlier rule has
rejected. fit_order() measures each rule on a bounded sample, its seconds above those of the words and the share it rejects,
and puts the rules in order of rejections per second. The order changes the cost alone: a document is kept if no rule
rejects it, whatever the order.

Null text counts as empty and fails "few words". Empty tables give empty results. Repeated rows and repeated doc_ids are
judged row by row. Very long texts take n log n time, and windows are compared by 64-bit hashes. Extra columns pass
through; a column with the name of a metric is replaced by the metric.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, SPACE_PATTERN

SYMBOLS = "#*$%&|<>"


def _let(value: Column, body) -> Column:
    """body(value) with value evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_PATTERN), "")


def n_words(text: Column, words: Column) -> Column:
    return F.size(words).cast("long")


def word_chars(text: Column, words: Column) -> Column:
    return F.length(F.array_join(words, "")).cast("long")


def n_symbols(text: Column, words: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(f"[{SYMBOLS}]")).cast("long")


def _lines(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.length(F.btrim(x, F.lit(SPACE))) > 0)


def n_lines(text: Column, words: Column) -> Column:
    return F.size(_lines(text)).cast("long")


def n_dup_lines(text: Column, words: Column) -> Column:
    return _let(_lines(text), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def n_repeat_words(text: Column, words: Column) -> Column:
    """Words in 3-word windows that stand twice or more in the text.

    A text whose windows are all different is done after one hash set. Otherwise the high bits of a window's hash and its
    place share one long, so that one sort of longs brings equal windows together: n log n time, whatever the text
    repeats. Where the cut-off bits make different windows meet (as many groups as distinct hashes is the sign that they
    don't), the whole hashes are sorted beside their places instead.
    """
    zero = F.lit(0).cast("long")

    def covered(places: Column) -> Column:
        return F.aggregate(
            F.sort_array(places),
            F.struct(F.lit(-3).cast("long").alias("last"), zero.alias("n")),
            lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(3).cast("long"), p - a["last"])).alias("n")),
            lambda a: a["n"],
        )

    def whole(h: Column) -> Column:
        def twice(v: Column) -> Column:
            return F.filter(v, lambda x, i: ((i > 0) & (x["h"] == F.get(v, i - 1)["h"])) | (x["h"] == F.get(v, i + 1)["h"]))

        return _let(F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.cast("long").alias("i")))), lambda v: covered(F.transform(twice(v), lambda x: x["i"])))

    def packed(h: Column, distinct: Column) -> Column:
        def of_bits(bits: Column) -> Column:
            return _let(F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1, lambda low: _let(F.sort_array(F.transform(h, lambda x, i: F.call_function("shiftleft", x, bits).bitwiseOR(i.cast("long")))), lambda v: of_sorted(v, low)))

        def of_sorted(v: Column, low: Column) -> Column:
            # equal high bits differ in their places alone
            after = F.filter(v, lambda x, i: x.bitwiseXOR(F.get(v, i - 1)).between(0, low))
            before = F.filter(v, lambda x, i: x.bitwiseXOR(F.get(v, i + 1)).between(0, low))
            places = F.transform(F.array_distinct(F.concat(before, after)), lambda x: x.bitwiseAND(low))
            return F.when(F.size(v) - F.size(after) == distinct, covered(places)).otherwise(whole(h))

        return _let(F.length(F.bin(F.size(h))), of_bits)

    def of_hashes(h: Column) -> Column:
        return _let(F.size(F.array_distinct(h)), lambda n: F.when(n == F.size(h), zero).otherwise(packed(h, n)))

    windows = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(F.size(words) < 3, zero).otherwise(_let(windows, of_hashes))


METRICS = {f.__name__: f for f in (n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines)}
#: Metrics of the base rules and the report; others are computed where a rule asks for them.
REPORTED = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Rule:
    """reject(m) is true where the rule rejects; m(name) gives a metric of METRICS."""

    name: str
    reject: object


def default_rules(min_words=50, max_repeat_pct=50, max_symbols_per_10_words=1, mean_word=(2, 14), max_dup_line_pct=40) -> list[Rule]:
    """The first two are the base rules of the query."""
    return [
        Rule("few_words", lambda m: m("n_words") < min_words),
        Rule("repeated_windows", lambda m: 100 * m("n_repeat_words") > max_repeat_pct * m("n_words")),
        Rule("symbols", lambda m: 10 * m("n_symbols") > max_symbols_per_10_words * m("n_words")),
        Rule("word_length", lambda m: (m("word_chars") < mean_word[0] * m("n_words")) | (m("word_chars") > mean_word[1] * m("n_words"))),
        Rule("duplicate_lines", lambda m: 100 * m("n_dup_lines") > max_dup_line_pct * m("n_lines")),
    ]


def from_words(text: Column, words: Column):
    """Metrics computed where a rule asks for them, so that a short circuit saves their cost."""
    return lambda name: METRICS[name](text, words)


def fit_order(docs: DataFrame, rules: list[Rule], sample_rows: int = 256, sample_chars: int = 1 << 16, repeat: int = 8) -> list[tuple[Rule, float, float]]:
    """(rule, seconds, share rejected) in cascade order.

    The sample is the first sample_rows rows of at most sample_chars characters, so that no more of docs is read than they
    need and at most their product reaches the driver. Each rule runs over it `repeat` times in a warm job, and the time of
    the same job without a rule is taken off.
    """
    rows = docs.select("text").filter(F.coalesce(F.length("text"), F.lit(0)) <= sample_chars).take(sample_rows)
    sample = docs.sparkSession.createDataFrame([(r["text"],) for r in rows], "text string").coalesce(1)
    each = sample.select("text", F.explode(F.sequence(F.lit(1), F.lit(repeat))).alias("r"))

    def run(rule: Rule | None) -> tuple[float, int]:
        text = F.col("text")
        verdict = _let(words_of(text), lambda w: F.size(w) < 0 if rule is None else F.coalesce(rule.reject(from_words(text, w)), F.lit(False)))
        took = []
        for _ in range(2):
            began = time.perf_counter()
            rejected = each.agg(F.count_if(verdict)).first()[0]
            took.append(time.perf_counter() - began)
        return min(took), rejected

    idle = run(None)[0]
    timed = [(rule, *run(rule)) for rule in rules]
    fitted = [(rule, max(1e-4, s - idle), n / max(1, repeat * len(rows))) for rule, s, n in timed]
    return sorted(fitted, key=lambda x: -x[2] / x[1])


def rejected_by(rules: list[Rule], metric) -> Column:
    """Name of the first rule of the cascade that rejects, null if none does."""
    case = None
    for rule in rules:
        hit = F.coalesce(rule.reject(metric), F.lit(False))
        case = F.when(hit, F.lit(rule.name)) if case is None else case.when(hit, F.lit(rule.name))
    return case if case is not None else F.lit(None).cast("string")


def quality_filter(docs: DataFrame, rules: list[Rule] | None = None, sample_rows: int = 256) -> DataFrame:
    """The rows of docs that no rule rejects, with the columns of docs."""
    order = [r for r, _, _ in fit_order(docs, rules or default_rules(), sample_rows)]
    text = F.col("text")
    return docs.filter(_let(words_of(text), lambda w: rejected_by(order, from_words(text, w))).isNull())


def quality_report(docs: DataFrame, rules: list[Rule] | None = None, sample_rows: int = 256) -> DataFrame:
    """All rows of docs with the metrics of REPORTED, base_failed and kept.

    The report asks for those metrics of every row; what other rules need is computed in the cascade, behind the base rules
    and in fitted order.
    """
    rules = rules or default_rules()
    base, extra = rules[:2], rules[2:]
    order = [r for r, _, _ in fit_order(docs, extra, sample_rows)]
    text = F.col("text")
    docs = docs.withColumn("_m", _let(words_of(text), lambda w: F.struct(*[METRICS[name](text, w).alias(name) for name in REPORTED])))
    docs = docs.withColumns({name: F.col(f"_m.{name}") for name in REPORTED}).drop("_m")
    metric = lambda name: F.col(name) if name in REPORTED else METRICS[name](text, words_of(text))
    docs = docs.withColumn("base_failed", rejected_by(base, metric).isNotNull())
    return docs.withColumn("kept", F.when(F.col("base_failed"), F.lit(False)).otherwise(rejected_by(order, metric).isNull()))
