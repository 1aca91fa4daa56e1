"""Quality rules: a learned decision list over statistics of whole texts.

Statistics are computed block by block inside Arrow tasks. Rules are learned by sequential covering: on two thirds of a
bounded sample of labelled statistics a rule grows one threshold at a time by information gain, on the last third it
loses conditions again while that raises its pruned value; then the texts that it covers are set aside and the next
rule grows. The list becomes one Spark conditional expression, read top down, and Catalyst evaluates it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .cluster import carried, without
from .textblocks import NEWLINE, SPACE, TextBlock, U, mix, small_batches, span_hash, windows

#: The characters that count as symbols.
SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
UPPER = np.zeros(256, bool)
UPPER[65:91] = True
DIGIT = np.zeros(256, bool)
DIGIT[48:58] = True
REPEAT_WIDTH = 5
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct_words", "n_upper", "n_digits", "n_marks"]
#: What rules may test, from the counts above.
MEASURES = {
    "word_length": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "distinct_share": ("n_distinct_words", "n_words"),
    "upper_share": ("n_upper", "word_chars"),
    "digit_share": ("n_digits", "word_chars"),
    "marks_per_word": ("n_marks", "n_words"),
}


def _repeats(key: np.ndarray) -> np.ndarray:
    """Whether each key occurs twice or more."""
    order = np.argsort(key)
    k = key[order]
    same = np.zeros(len(k) + 1, bool)
    same[1:-1] = k[1:] == k[:-1]
    out = np.zeros(len(k), bool)
    out[order] = same[1:] | same[:-1]
    return out


def text_counts(text: pa.Array) -> dict[str, np.ndarray]:
    """COUNTS of every text, null texts as empty ones."""
    block = TextBlock.of(text)
    d, off = block.data, block.off
    starts, ends, first = block.spans()

    def per_text(flags: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])[off])

    out = {"n_words": np.diff(first)}
    out["word_chars"] = per_text(~SPACE[d] & ((d & 0xC0) != 0x80))
    out["n_symbols"] = per_text(SYMBOLS[d])
    out["n_upper"], out["n_digits"] = per_text(UPPER[d]), per_text(DIGIT[d])
    out["n_marks"] = per_text(d == 33)
    hashes = span_hash(d, starts, ends)
    doc = np.repeat(np.arange(block.n), out["n_words"])
    tag = mix(np.arange(1, block.n + 1, dtype=U))
    at, h = windows(hashes, first, REPEAT_WIDTH)
    hit = at[_repeats(h ^ tag[doc[at]])]
    cover = np.zeros(len(starts) + 1, np.int64)
    for k in range(REPEAT_WIDTH):
        cover[hit + k] = 1
    out["n_repeat_words"] = np.diff(np.concatenate([[0], np.cumsum(cover)])[first])
    out["n_distinct_words"] = np.bincount(doc[np.unique(hashes ^ tag[doc], return_index=True)[1]], minlength=block.n) if len(doc) else np.zeros(block.n, np.int64)
    ls, le, lf = block.spans(NEWLINE)
    words_before = np.searchsorted(starts, np.concatenate([ls, le]))
    worded = words_before[len(ls) :] > words_before[: len(ls)]
    line_doc = np.repeat(np.arange(block.n), np.diff(lf))[worded]
    key = span_hash(d, ls, le)[worded] ^ tag[line_doc]
    out["n_lines"] = np.bincount(line_doc, minlength=block.n)
    once = np.unique(key, return_index=True)[1]
    out["n_dup_lines"] = out["n_lines"] - np.bincount(line_doc[once], minlength=block.n)
    return out


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs' other columns with COUNTS (long) added; input columns of those names are replaced.

    Null and empty texts count zero of everything; very long ones are one block of their own. Repeated rows are counted
    each on its own. An empty table gives an empty result.
    """
    base = without(carried(docs), *COUNTS)
    keep = [c for c in base.columns if c != text]
    at = base.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, text):
            counts = text_counts(batch.column(at))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(batch.num_columns) if i != at), *(pa.array(counts[c], pa.int64()) for c in COUNTS)], names=[*keep, *COUNTS])

    fields = [f for f in base.schema.fields if f.name != text]
    return base.mapInArrow(run, T.StructType([*fields, *(T.StructField(c, T.LongType()) for c in COUNTS)]))


def base_failed() -> Column:
    """The fixed base rules."""
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def measure(name: str) -> Column:
    """A measure as a Spark expression; 0 where nothing is there to divide by."""
    a, b = MEASURES[name]
    return F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")), F.lit(0.0))


@dataclass(frozen=True)
class Condition:
    measure: str
    above: bool  # value > threshold, else value <= threshold
    threshold: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.measure] > self.threshold if self.above else x[self.measure] <= self.threshold

    def column(self) -> Column:
        return measure(self.measure) > self.threshold if self.above else measure(self.measure) <= self.threshold


Rule = tuple[Condition, ...]


def _covers(rule: Rule, x: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, bool)
    for c in rule:
        out &= c.holds(x)
    return out


def _grow(x: dict[str, np.ndarray], bad: np.ndarray, most: int) -> Rule:
    rule: Rule = ()
    inside = np.ones(len(bad), bool)
    while len(rule) < most and bad[inside].mean() < 1:
        p0, n0 = bad[inside].sum(), (~bad[inside]).sum()
        best, gain = None, 1e-9
        for name, values in x.items():
            v = values[inside]
            cuts = np.unique(np.quantile(v, np.linspace(0, 1, 65)))
            for above in (True, False):
                for a, b in zip(cuts[:-1], cuts[1:]):
                    c = Condition(name, above, float((a + b) / 2))
                    hit = v > c.threshold if above else v <= c.threshold
                    p, n = bad[inside][hit].sum(), (~bad[inside][hit]).sum()
                    if p:
                        g = p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0)))
                        if g > gain:
                            best, gain = c, g
        if best is None:
            break
        rule += (best,)
        inside &= best.holds(x)
    return rule


def _prune(rule: Rule, x: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    def worth(r: Rule) -> float:
        hit = _covers(r, x, len(bad))
        p, n = bad[hit].sum(), (~bad[hit]).sum()
        return (p - n) / (p + n) if p + n else -1.0

    best = max((rule[:k] for k in range(1, len(rule) + 1)), key=lambda r: (worth(r), -len(r)))
    return best


def learn(x: dict[str, np.ndarray], bad: np.ndarray, most_rules: int = 12, most_conditions: int = 3, precision: float = 0.9, least: int = 5) -> list[Rule]:
    """Rules that reject, in order. A rule enters only if, over all that earlier rules left, it covers at least `least`
    texts and at least `precision` of them are bad; so clean texts stay. Without both labels there is no rule."""
    rules: list[Rule] = []
    left = np.ones(len(bad), bool)
    turn = np.arange(len(bad)) % 3
    for _ in range(most_rules):
        grow, prune = left & (turn != 2), left & (turn == 2)
        if bad[left].sum() < least or not bad[grow].any() or bad[left].all():
            break
        rule = _grow({k: v[grow] for k, v in x.items()}, bad[grow], most_conditions)
        if not rule:
            break
        rule = _prune(rule, {k: v[prune] for k, v in x.items()}, bad[prune]) if prune.any() else rule
        hit = _covers(rule, x, len(bad)) & left
        if hit.sum() < least or bad[hit].mean() < precision:
            break
        rules.append(rule)
        left &= ~hit
        turn = np.where(left, np.cumsum(left) % 3, turn)
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The decision list as one conditional expression: true keeps. First rule that holds decides; the last word is keep."""
    if not rules:
        return F.lit(True)
    out = None
    for rule in rules:
        test = rule[0].column()
        for c in rule[1:]:
            test = test & c.column()
        out = F.when(test, F.lit(False)) if out is None else out.when(test, F.lit(False))
    return out.otherwise(F.lit(True))


def learn_from(stats: DataFrame, labels: DataFrame, most: int = 20_000, id_col: str = "doc_id", label: str = "quality") -> list[Rule]:
    """Rules from the statistics of at most `most` labelled rows (least id hash); label 0 is bad.

    Texts that the base rules reject teach nothing: the list decides only on the others. An id with several labels has
    the largest; of several texts with one id that of the least statistics teaches.
    """
    few = labels.where(F.col(label).isNotNull()).select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{label}`").alias("__label")).groupBy("__id").agg(F.max("__label").alias("__label")).orderBy(F.xxhash64("__id"), "__id").limit(most)
    own = stats.join(F.broadcast(few), F.col(f"`{id_col}`") == F.col("__id")).where(~base_failed())
    one = own.groupBy("__id").agg(F.min("__label").alias("__label"), F.min(F.struct(*[measure(m).alias(m) for m in MEASURES])).alias("m")).orderBy(F.xxhash64("__id"), "__id")
    pdf: pd.DataFrame = one.select("__label", "m.*").toPandas()
    return learn({m: pdf[m].to_numpy(float) for m in MEASURES}, (pdf["__label"].to_numpy() == 0)) if len(pdf) else []


def apply_rules(stats: DataFrame, rules: list[Rule]) -> DataFrame:
    """stats with base_failed and kept added (columns of those names are replaced).

    Null, empty and wordless texts fail the base rules. Repeated rows are judged each on its own. An empty table gives
    an empty result.
    """
    base = without(stats, "base_failed", "kept")
    return base.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & verdict(rules))
