"""Quality rules: a decision list learned from labelled documents.

Every document is described by counts that a reader can check (words, symbols, repeated lines, ...) and their shares.
Sequential covering learns one rule at a time: a rule grows by the threshold that gains most on two thirds of the
labelled documents, is pruned back to the conditions that hold up on the other third, and takes what it covers out of
both. Rules are tried in order; the first one that holds rejects a document. The list is emitted as one Spark
expression over the counts, and the only scan of the corpus is the one that counts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stored
from . import _stretches as S
from . import _text as T
from .registry import query, table

# Labelled documents that the rules are learned from, at most.
SAMPLE = 16384
WINDOW = 3
SYMBOLS = b"#*$%&|<>"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BASE_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
COUNTS = (*BASE_COUNTS, "n_distinct", "n_capitals", "n_digits", "n_marks", "n_flagged")
# What conditions look at: a count, or a count over another one.
FEATURES = {
    "symbol_share": ("n_symbols", "word_chars"), "repeat_share": ("n_repeat_words", "n_words"),
    "distinct_share": ("n_distinct", "n_words"), "capital_share": ("n_capitals", "word_chars"),
    "digit_share": ("n_digits", "word_chars"), "mark_share": ("n_marks", "word_chars"),
    "chars_per_word": ("word_chars", "n_words"), "dup_lines": ("n_dup_lines", None), "flagged": ("n_flagged", None),
    "flagged_share": ("n_flagged", "n_words"),
}
_COUNTED = ", ".join(f"{c} long" for c in COUNTS)


def _mask(members: Iterable[int]) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(members)] = True
    return out


_IS_SYMBOL = _mask(SYMBOLS)
_IS_CAPITAL = _mask(range(65, 91))
_IS_DIGIT = _mask(range(48, 58))
_IS_MARK = _mask(b"!?.,;:")
# First bytes of characters that are part of a word.
_IS_CHAR = T.word_bytes("space") & ~_mask(range(0x80, 0xC0))


def _distinct_per_text(owner: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    return np.bincount(owner[new], minlength=n)


def _repeated_words(hashes: np.ndarray, ends: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Words inside windows of WINDOW words that the text holds twice or more, the first one included."""
    windows = T.window_hashes(hashes, WINDOW)
    at = np.flatnonzero(T.whole(ends, WINDOW))
    if not len(at):
        return np.zeros(n, np.int64)
    windows, text = windows[at], owner[at]
    order = np.lexsort((windows, text))
    same = (windows[order][1:] == windows[order][:-1]) & (text[order][1:] == text[order][:-1])
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    starts = at[twice]
    return np.bincount(owner[T.covered(starts, starts + WINDOW, len(hashes))], minlength=n)


def count(piece: T.Piece, flagged: np.ndarray) -> np.ndarray:
    """COUNTS (columns) of the texts of a piece (rows); ``flagged`` are sorted hashes of lower-cased words. Words and
    lines stand for themselves as 64-bit hashes."""
    n = len(piece)
    starts, hashes, ends = S.runs(piece, T.word_bytes("space"))
    owner = T.owners(ends)
    lines, line_hashes, line_ends = S.runs(piece, S.line_bytes())
    # Lines with a word: one begins before the next line does.
    full = np.diff(np.searchsorted(starts, np.append(lines, len(piece.bytes)))) > 0
    line_owner = T.owners(line_ends)[full]
    dup = np.bincount(line_owner, minlength=n) - _distinct_per_text(line_owner, line_hashes[full], n)
    if len(flagged):
        _, plain, plain_ends = S.runs(piece, T.word_bytes("alnum"), lower=True)
        at = np.searchsorted(flagged, plain)
        hit = flagged[np.minimum(at, len(flagged) - 1)] == plain
        n_flagged = np.bincount(T.owners(plain_ends)[hit], minlength=n)
    else:
        n_flagged = np.zeros(n, np.int64)
    return np.stack([np.diff(ends), S.count_bytes(piece, _IS_CHAR), S.count_bytes(piece, _IS_SYMBOL), dup,
                     _repeated_words(hashes, ends, owner, n), _distinct_per_text(owner, hashes, n),
                     S.count_bytes(piece, _IS_CAPITAL), S.count_bytes(piece, _IS_DIGIT), S.count_bytes(piece, _IS_MARK),
                     n_flagged], axis=1).astype(np.int64)


def _hashes(words: Sequence[str]) -> np.ndarray:
    if not words:
        return np.zeros(0, T.U64)
    piece = next(T.pieces(pa.array(list(words)), limit=1 << 30))
    return np.unique(T.segment_hashes(piece.bytes, piece.ends[:-1], piece.ends[1:], lower=True))


def counted(docs: DataFrame, flagged: Sequence[str] = (), keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns of every row and its COUNTS (long), over its whole ``text`` (null: empty).

    word_chars: code points in words (what stands between white space); n_symbols: characters of ``#*$%&|<>``;
    n_dup_lines: lines with a word that are equal to an earlier one; n_repeat_words: words in windows of three that
    occur twice or more; n_distinct: different words; n_capitals, n_digits: A-Z, 0-9; n_marks: ``!?.,;:``; n_flagged:
    words of ``flagged``.
    """
    names = [f"c{i}" for i in range(len(keep))]
    inner = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names)], F.col("text").alias("__text"))
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in inner.schema.fields[:-1]] + [_COUNTED])
    sought = _hashes(flagged)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [count(piece, sought) for piece in T.pieces(batch.column(batch.num_columns - 1))]
            numbers = np.concatenate([np.zeros((0, len(COUNTS)), np.int64), *parts])
            yield pa.RecordBatch.from_arrays(batch.columns[:-1] + [pa.array(c) for c in numbers.T],
                                             names + list(COUNTS))

    out = inner.mapInArrow(run, schema)
    return out.select(*[F.col(n).alias(c) for c, n in zip(keep, names)], *COUNTS)


def feature(name: str) -> Column:
    """A feature as a column over COUNTS; a share of nothing is 0."""
    top, below = FEATURES[name]
    value = F.col(top).cast("double")
    return value if below is None else F.coalesce(F.try_divide(value, F.col(below).cast("double")), F.lit(0.0))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool  # at least the limit, or else below it
    limit: float

    def holds(self, values: np.ndarray) -> np.ndarray:
        column = values[:, list(FEATURES).index(self.feature)]
        return column >= self.limit if self.above else column < self.limit

    def column(self) -> Column:
        value = feature(self.feature)
        return value >= F.lit(self.limit) if self.above else value < F.lit(self.limit)

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<'} {self.limit:g}"


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]

    def holds(self, values: np.ndarray) -> np.ndarray:
        out = np.ones(len(values), bool)
        for condition in self.conditions:
            out &= condition.holds(values)
        return out

    def column(self) -> Column:
        out = self.conditions[0].column()
        for condition in self.conditions[1:]:
            out &= condition.column()
        return out

    def __str__(self) -> str:
        return " and ".join(map(str, self.conditions))


@dataclass
class DecisionList:
    """Rules that reject, tried in order; what none of them covers stays. ``flagged``: the words that count as such."""

    rules: list[Rule] = field(default_factory=list)
    flagged: list[str] = field(default_factory=list)

    def first_rule(self) -> Column:
        """Number (from 1) of the first rule that holds, over COUNTS; null without one."""
        out = F.when(F.lit(False), F.lit(0))
        for i, rule in enumerate(self.rules, 1):
            out = out.when(rule.column(), F.lit(i))
        return out

    def keeps(self) -> Column:
        return self.first_rule().isNull()

    def __str__(self) -> str:
        return "\n".join([*(f"{i}. reject if {rule}" for i, rule in enumerate(self.rules, 1)), "else keep"])


def _best_condition(values: np.ndarray, bad: np.ndarray) -> tuple[float, Condition | None]:
    """The condition of the highest information gain for the rejected rows among ``values``."""
    p0, n0 = int(bad.sum()), int((~bad).sum())
    best, found = 1e-9, None
    base = np.log2(p0 / (p0 + n0))
    for j, name in enumerate(FEATURES):
        order = np.argsort(values[:, j], kind="stable")
        column, hits = values[order, j], np.cumsum(bad[order])
        cuts = np.flatnonzero(column[1:] > column[:-1]) + 1  # rows below the cut
        if not len(cuts):
            continue
        p_low, n_low = hits[cuts - 1], cuts - hits[cuts - 1]
        for above, p, n in ((True, p0 - p_low, n0 - n_low), (False, p_low, n_low)):
            gain = p * (np.log2(np.maximum(p, 1e-12) / (p + n)) - base)
            i = int(np.argmax(gain))
            if gain[i] > best:
                lo, hi = column[cuts[i] - 1], column[cuts[i]]
                limit = float(f"{(lo + hi) / 2:.4g}")
                best, found = float(gain[i]), Condition(name, above, limit if lo < limit <= hi else float(hi))
    return best, found


def grow(values: np.ndarray, bad: np.ndarray, most: int) -> Rule:
    """Add conditions while rows that are to stay are still covered."""
    conditions: list[Condition] = []
    while len(conditions) < most and bad.any() and not bad.all():
        _, condition = _best_condition(values, bad)
        if condition is None:
            break
        conditions.append(condition)
        inside = condition.holds(values)
        values, bad = values[inside], bad[inside]
    return Rule(tuple(conditions))


def prune(rule: Rule, values: np.ndarray, bad: np.ndarray) -> Rule:
    """The first conditions of a rule that do best on rows it was not grown on; of equals, the shorter rule."""
    def worth(k: int) -> float:
        inside = Rule(rule.conditions[:k]).holds(values)
        p, n = int((inside & bad).sum()), int((inside & ~bad).sum())
        return (p - n) / (p + n + 1)

    sizes = range(1, len(rule.conditions) + 1)
    return Rule(rule.conditions[:max(sizes, key=lambda k: (round(worth(k), 6), -k))]) if rule.conditions else rule


def learn(values: np.ndarray, bad: np.ndarray, held: np.ndarray, precision: float = 0.9, most: int = 4,
          least: int = 3) -> list[Rule]:
    """Sequential covering over FEATURES (columns of ``values``). Rules are grown on the rows that are not ``held`` and
    pruned on those that are. It ends with the first rule that covers fewer than ``least`` grown rows to reject, or
    whose rows, grown or held, are rightly rejected in a share below ``precision``."""
    rules: list[Rule] = []
    open_ = np.ones(len(bad), bool)
    while (bad & open_ & ~held).any():
        a, b = open_ & ~held, open_ & held
        rule = grow(values[a], bad[a], most)
        if not rule.conditions:
            break
        rule = prune(rule, values[b], bad[b]) if (bad & b).any() else rule
        covers = rule.holds(values) & open_
        right = [int((covers & bad & part).sum()) for part in (a, b)]
        wrong = [int((covers & ~bad & part).sum()) for part in (a, b)]
        if right[0] < least or any(r < precision * (r + w) for r, w in zip(right, wrong)):
            break
        rules.append(rule)
        open_ &= ~covers
    return rules


def _labelled(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """(near, held, bad, text) of at most ``sample`` labelled documents: rows of low quality or toxic are bad, also if
    only one of several labels says so. Near copies (equal least 5-word window) count once, a bad one first."""
    bad = (F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))).cast("int")
    known = F.col("quality").isNotNull() | F.col("toxic").isNotNull()
    order = F.xxhash64("doc_id")
    sheet = (labels.where(F.col("doc_id").isNotNull() & known).groupBy("doc_id").agg(F.max(bad).alias("bad"))
             .orderBy(order, "doc_id").limit(sample))

    def near(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for piece in T.pieces(batch.column(1)):
                _, hashes, ends = S.runs(piece, T.word_bytes("alnum"), lower=True)
                windows = T.window_hashes(hashes, 5)
                windows = np.where(T.whole(ends, 5), windows, T.TOP) if len(windows) else windows
                out += [windows[a:b].min(initial=T.TOP) for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(np.array(out, T.U64).view(np.int64)), *batch.columns],
                                             ["near", "bad", "text"])

    # At most ``sample`` rows of two numbers.
    rows = docs.select("doc_id", "text").where("text IS NOT NULL").join(F.broadcast(sheet), "doc_id").select("bad", "text")
    first = F.min(F.struct((-F.col("bad")).alias("fine"), "text"))
    # Texts without five words have no window and stand for themselves.
    key = F.when(F.col("near") == -1, F.xxhash64("text")).otherwise(F.col("near"))
    return (rows.mapInArrow(near, "near long, bad int, text string").groupBy(key.alias("near")).agg(first.alias("first"))
            .select("near", (F.pmod(F.col("near"), F.lit(3)) == 0).alias("held"), (F.col("first.fine") == -1).alias("bad"),
                    "first.text"))


def flagged_words(rows: DataFrame) -> list[str]:
    """Words (lower-cased) that go with bad rows of (bad, text): twice the log likelihood ratio of their rows is above
    12 plus twice the logarithm of the number of words looked at, so that hardly one gets there by accident."""
    low = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = rows.select("bad", F.explode(F.array_distinct(F.regexp_extract_all(low, F.lit(WORD), F.lit(0)))).alias("word"))
    counts = stored(words.groupBy("word").agg(F.count("*").alias("n"), F.sum(F.col("bad").cast("int")).alias("k"))
                    .where("n >= 3"), "rule-words")
    total = rows.agg(F.count("*").alias("n"), F.sum(F.col("bad").cast("int")).alias("k")).first()
    if not total["n"] or not total["k"] or total["k"] == total["n"]:
        return []
    share, p = total["k"] / total["n"], (F.col("k") + 0.01) / (F.col("n") + 0.02)
    gain = 2 * (F.col("k") * F.log(p / share) + (F.col("n") - F.col("k")) * F.log((1 - p) / (1 - share)))
    limit = 12 + 2 * float(np.log(max(counts.count(), 1)))
    return sorted(r["word"] for r in counts.where((p > share) & (gain > limit)).select("word").collect())


def base_failed() -> Column:
    """Too short, or mostly repeated: over COUNTS, before any rule."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, precision: float = 0.9) -> DecisionList:
    """A decision list for ``labels`` (doc_id, quality 0/1, toxic 0/1; nulls say nothing) of ``docs``.

    Learned from at most ``sample`` labelled documents, those with the least hashes of their ids, that pass the base
    rule. Without labelled documents the list is empty and keeps everything.
    """
    rows = stored(_labelled(docs, labels, sample), "rule-sample")
    flagged = flagged_words(rows.where("NOT held"))
    passed = counted(rows, flagged, ("near", "held", "bad")).where(~base_failed())
    local = passed.select("held", "bad", *[feature(name).alias(name) for name in FEATURES]).orderBy("near").collect()
    values = np.array([[r[name] for name in FEATURES] for r in local], float).reshape(len(local), len(FEATURES))
    bad, held = np.array([r["bad"] for r in local], bool), np.array([r["held"] for r in local], bool)
    rules = learn(values, bad, held, precision)
    used = any(c.feature.startswith("flagged") for rule in rules for c in rule.conditions)
    return DecisionList(rules, flagged if used else [])


def judge(docs: DataFrame, rules: DecisionList, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns, COUNTS, ``base_failed``, ``rule`` (number of the first rule that holds, else null) and
    ``kept`` of every row. A null or empty text has no words and fails the base rule; equal texts fare alike."""
    return (counted(docs, rules.flagged, keep).withColumn("base_failed", base_failed())
            .withColumn("rule", rules.first_rule()).withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull()))


@query()
def op12_decision_list_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of every document and what base rule and learned rules say."""
    docs = table(spark, folder, "documents")
    return judge(docs, fit(docs, table(spark, folder, "labels"))).select("doc_id", *BASE_COUNTS, "base_failed", "kept", "rule")
