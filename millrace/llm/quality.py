"""Quality classifier from weak labels.

Documents are of three kinds: fine, low (in quality) or toxic. Several labellers look at a document and vote for a kind
or not at all: counts of words and characters, a short list of insults, words that go with toxic rows of the label
sheet, and the sheet itself. Expectation-maximisation estimates from their agreements how often each votes what on
documents of each kind, and with that the chance that a document is low or toxic. These chances train a linear scorer
over hashed features (words, word beginnings, count levels), which then scores every document without any labeller.

The models are fitted on a bounded sample (``sample`` rows of the sheet and a quarter as many of all documents, those
with the least hashes of their ids); everything else runs over all rows in one scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _text as T
from ..session import stored
from .registry import query, table

SAMPLE = 16384
BUCKETS = 1 << 20
# Bytes of the word beginnings that are features besides whole words.
BEGINNINGS = (4, 5, 6)
# Features that may get a weight.
CANDIDATES = 4096
INSULTS = ("idiot", "idiots", "moron", "morons", "stupid", "dumb", "loser", "losers", "scum", "trash", "pathetic",
           "worthless", "disgusting", "clown")
# Counts of a document and the steps at which their levels begin.
COUNTS = ("distinct", "repeats", "capitals", "symbols", "digits")
STEPS = 20
FINE, LOW, TOXIC, NOTHING = 0, 1, 2, 3


def _feature(hashes: np.ndarray, kind: int) -> np.ndarray:
    salt = T.U64((kind * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    return (T.mix(hashes + salt) & T.U64(BUCKETS - 1)).astype(np.int64)


def _distinct(owner: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((values, owner))
    owner, values = owner[order], values[order]
    keep = np.append(True, (owner[1:] != owner[:-1]) | (values[1:] != values[:-1]))[:len(owner)]
    return owner[keep], values[keep]


@dataclass
class Read:
    """What is read off a piece: words, counts per document (columns as COUNTS), features by word."""

    piece: T.Piece
    n_words: np.ndarray
    owner: np.ndarray
    hashes: np.ndarray
    counts: np.ndarray
    features: list[tuple[np.ndarray, np.ndarray]]  # (document, feature) for each kind of feature


def _shares(mask: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask)])
    return total[ends[1:]] - total[ends[:-1]]


_SYMBOL = np.zeros(256, bool)
_SYMBOL[0x21:0x30] = _SYMBOL[0x3A:0x41] = _SYMBOL[0x5B:0x61] = _SYMBOL[0x7B:0x7F] = True
_SYMBOL[[0x2C, 0x2E, 0x27, 0x2D]] = False


def read(piece: T.Piece) -> Read:
    found = T.words(piece, "alnum")
    hashes = T.segment_hashes(piece.bytes, found.starts, found.stops, lower=True)
    owner = T.owners(found.ends)
    n = np.diff(found.ends)
    least = np.maximum(n, 1)
    once = np.bincount(_distinct(owner, hashes)[0], minlength=len(piece))
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    data = piece.bytes
    size = np.maximum(np.diff(piece.ends), 1)
    capital, small = (data >= 65) & (data <= 90), (data >= 97) & (data <= 122)
    letters = np.maximum(_shares(capital | small, piece.ends), 1)
    counts = np.stack([once / least, _shares(same, found.ends) / least, _shares(capital, piece.ends) / letters,
                       _shares(_SYMBOL[data], piece.ends) / size,
                       _shares((data >= 48) & (data <= 57), piece.ends) / size], axis=1)
    counts[n == 0, 0] = 1.0
    features = [(owner, _feature(hashes, 0))]
    for kind, width in enumerate(BEGINNINGS, 1):
        long = np.flatnonzero(found.stops - found.starts > width)
        features.append((owner[long], _feature(
            T.segment_hashes(data, found.starts[long], found.starts[long] + width, lower=True), kind)))
    # Levels: one feature for each step that a count has passed, so that neighbouring levels share weights.
    for c in range(len(COUNTS)):
        step = np.minimum((counts[:, c] * STEPS).astype(np.int64), STEPS)
        who = np.repeat(np.arange(len(piece)), step)
        level = T.ranges(np.ones(len(step), np.int64), step).astype(T.U64) + T.U64(100 * c)
        features.append((who, _feature(level, 10)))
    return Read(piece, n, owner, hashes, counts, features)


_INSULTS = None


def _insults() -> np.ndarray:
    global _INSULTS
    if _INSULTS is None:
        piece = next(T.pieces(pa.array(list(INSULTS))))
        found = T.words(piece, "alnum")
        _INSULTS = np.sort(T.segment_hashes(piece.bytes, found.starts, found.stops, lower=True))
    return _INSULTS


def heuristic_votes(r: Read) -> np.ndarray:
    """Votes per document (rows) and labeller (columns). No labeller looks at what another one looks at to abstain:
    plain prose votes fine whether or not it insults, and the estimates show that it says nothing about that."""
    distinct, repeats, capitals, symbols, digits = r.counts.T
    insulted = np.zeros(len(r.piece), bool)
    insulted[r.owner[np.isin(r.hashes, _insults())]] = True
    prose = (distinct > 0.45) & (repeats < 0.3) & (capitals < 0.2) & (symbols < 0.05)
    votes = [np.where(low, LOW, NOTHING) for low in
             ((distinct < 0.35) & (r.n_words >= 20), (repeats > 0.3) & (r.n_words >= 10), capitals > 0.4,
              symbols > 0.12)]
    return np.stack([*votes, np.where(insulted, TOXIC, NOTHING), np.where(prose, FINE, NOTHING)],
                    axis=1).astype(np.int8)


def fit_labellers(votes: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expectation-maximisation for votes (documents x labellers; a kind or NOTHING).

    Returns the chance of each document to be of each kind, the chance of each vote by labeller and kind (labellers x
    kinds x votes), and the shares of the kinds. Starts from the plain balance of votes.
    """
    n, m = votes.shape
    chance = np.stack([(votes == kind).sum(axis=1) for kind in (FINE, LOW, TOXIC)], axis=1) + 0.05
    chance /= chance.sum(axis=1, keepdims=True)
    rates, shares = np.zeros((m, 3, 4)), np.full(3, 1 / 3)
    for _ in range(rounds):
        shares = (chance.sum(axis=0) + 1) / (n + 3)
        for j in range(m):
            for vote in range(4):
                rates[j, :, vote] = chance[votes[:, j] == vote].sum(axis=0)
        rates = (rates + 0.1) / (rates + 0.1).sum(axis=2, keepdims=True)
        logs = np.log(shares)[None, :] + sum(np.log(rates[j])[:, votes[:, j]].T for j in range(m))
        new = np.exp(logs - logs.max(axis=1, keepdims=True))
        new /= new.sum(axis=1, keepdims=True)
        moved = np.abs(new - chance).max(initial=0)
        chance = new
        if moved < 1e-6:
            break
    return chance, rates, shares


def fit_linear(rows: np.ndarray, columns: np.ndarray, n: int, m: int, chance: np.ndarray, penalty: float = 0.3,
               rounds: int = 600) -> tuple[np.ndarray, float]:
    """Weights and offset of a logistic scorer for the 0/1 matrix with ones at (rows, columns), towards soft labels.

    An absolute-value penalty leaves features without a weight that others make superfluous. Accelerated proximal
    steps, each weight with a step size of its own.
    """
    ones = np.bincount(columns, minlength=m).astype(float)
    per_row = max(1, int(np.bincount(rows, minlength=n).max(initial=1))) + 1
    step = 4.0 / (per_row * np.maximum(ones, 1))
    w, b = np.zeros(m), 0.0
    fast_w, fast_b, t = w.copy(), b, 1.0
    for _ in range(rounds):
        score = fast_b + np.bincount(rows, weights=fast_w[columns], minlength=n)
        error = 1 / (1 + np.exp(-np.clip(score, -50, 50))) - chance
        slope = np.bincount(columns, weights=error[rows], minlength=m)
        moved = fast_w - step * slope
        new_w = np.sign(moved) * np.maximum(np.abs(moved) - step * penalty, 0)
        new_b = fast_b - 4.0 / (per_row * max(n, 1)) * error.sum()
        later = (1 + np.sqrt(1 + 4 * t * t)) / 2
        fast_w, fast_b = new_w + (t - 1) / later * (new_w - w), new_b + (t - 1) / later * (new_b - b)
        w, b, t = new_w, new_b, later
    return w, b


@dataclass
class Scorer:
    """Weights over the hashed features, nearly all of them zero, and an offset."""

    features: np.ndarray  # sorted
    weights: np.ndarray
    offset: float
    labellers: np.ndarray | None = None  # estimated vote rates

    def score(self, r: Read) -> np.ndarray:
        """Chance to be a reject; 0 for documents without words."""
        table_ = np.zeros(BUCKETS, np.float32)
        table_[self.features] = 1
        hit_owner, hit_feature = [], []
        for owner, feature in r.features:
            at = np.flatnonzero(table_[feature])
            hit_owner.append(owner[at])
            hit_feature.append(feature[at])
        owner, feature = _distinct(np.concatenate(hit_owner), np.concatenate(hit_feature))
        sums = np.bincount(owner, weights=self.weights[np.searchsorted(self.features, feature)], minlength=len(r.piece))
        chance = 1 / (1 + np.exp(-np.clip(sums + self.offset, -50, 50)))
        return np.where(r.n_words > 0, chance, 0.0)


def _sampled(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """(doc_id, text, sheet) of the bounded sample; ``sheet`` is a kind or NOTHING, toxic where both hold."""
    order = F.xxhash64("doc_id")
    kind = F.when(F.col("toxic") == 1, TOXIC).when(F.col("quality") == 0, LOW).otherwise(FINE)
    known = F.col("quality").isNotNull() | F.col("toxic").isNotNull()
    sheet = (labels.where(F.col("doc_id").isNotNull() & known)
             .groupBy("doc_id").agg(F.max(kind).alias("sheet"))
             .orderBy(order, "doc_id").limit(sample))
    others = (docs.select("doc_id").where("doc_id IS NOT NULL").distinct().orderBy(order, "doc_id").limit(sample // 4)
              .select("doc_id", F.lit(NOTHING).alias("sheet")))
    chosen = sheet.union(others).groupBy("doc_id").agg(F.min("sheet").alias("sheet"))
    # At most 5/4 sample rows of two numbers.
    return (docs.select("doc_id", "text").where("text IS NOT NULL").join(F.broadcast(chosen), "doc_id"))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Scorer:
    """Fit label model and scorer. Near copies (equal least 5-word shingle, or equal shorter texts) count once, by a
    labelled one if there is any. Without any labels the heuristic labellers are left; without any document nothing is
    ever rejected."""
    schema = "near long, sheet int, votes array<byte>, features array<int>"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sheet = batch.column(2).to_numpy()
            for piece in T.pieces(batch.column(1)):
                r = read(piece)
                owner = np.concatenate([o for o, _ in r.features])
                owner, feature = _distinct(owner, np.concatenate([f for _, f in r.features]))
                cuts = np.searchsorted(owner, np.arange(len(piece) + 1))
                votes = heuristic_votes(r)
                windows = np.where(T.whole(r_ends := np.concatenate([[0], np.cumsum(r.n_words)]), 5),
                                   T.window_hashes(r.hashes, 5), T.TOP) if len(r.hashes) >= 5 else np.zeros(0, T.U64)
                near = np.array([int(windows[a:b].min(initial=T.TOP)) for a, b in zip(r_ends[:-1], r_ends[1:])], T.U64)
                alone = near == T.TOP
                near[alone] = T.mix(T.segment_hashes(piece.bytes, piece.ends[:-1][alone], piece.ends[1:][alone], lower=True))
                rows = slice(piece.first, piece.first + len(piece))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(near.view(np.int64)), pa.array(sheet[rows].astype(np.int32)),
                     pa.array(votes.tolist(), pa.list_(pa.int8())),
                     pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(feature, pa.int32()))],
                    ["near", "sheet", "votes", "features"])

    # Of near copies a labelled one stays, the worst kind first; the rest of the order only makes the choice definite.
    first = F.min(F.struct((F.col("sheet") == NOTHING).alias("open"), (-F.col("sheet")).alias("kind"), "votes", "features"))
    rows = stored(_sampled(docs, labels, sample).mapInArrow(run, schema).groupBy("near").agg(first.alias("first"))
                  .select("near", (-F.col("first.kind")).alias("sheet"), "first.votes", "first.features"), "quality-sample")
    # Words that go with a kind are sought by what the sheet says. Low rows without a word of the sheet are those that
    # the heuristics vote low; toxic ones are known from the sheet alone, unless it is empty.
    on_sheet = F.col("sheet") != NOTHING
    voted = {kind: F.array_contains("votes", F.lit(kind).cast("byte")) for kind in (LOW, TOXIC)}
    told = on_sheet if rows.where(on_sheet).count() else F.lit(True)
    known = rows.withColumns({
        "n_low": F.lit(1), "low": F.when(on_sheet, F.col("sheet") == LOW).otherwise(voted[LOW]).cast("int"),
        "n_toxic": told.cast("int"),
        "toxic": (told & F.when(on_sheet, F.col("sheet") == TOXIC).otherwise(voted[TOXIC])).cast("int")})
    sums = [F.sum(c).alias(c) for c in ("n_low", "low", "n_toxic", "toxic")]
    totals = known.agg(*sums).first()
    if not totals["n_low"]:
        return Scorer(np.zeros(0, np.int64), np.zeros(0), -10.0)
    counts = (known.select("n_low", "low", "n_toxic", "toxic", F.explode("features").alias("feature"))
              .groupBy("feature").agg(*sums).where("n_low >= 3"))
    # How surprising a kind's rows among a feature's rows are: twice the log likelihood ratio.
    for kind in ("low", "toxic"):
        share = min(0.99, max(0.01, totals[kind] / max(1, totals[f"n_{kind}"])))
        n = F.col(f"n_{kind}")
        p = (F.col(kind) + 0.01) / (n + 0.02)
        gain = 2 * (F.col(kind) * F.log(p / share) + (n - F.col(kind)) * F.log((1 - p) / (1 - share)))
        counts = counts.withColumns({f"p_{kind}": p, f"gain_{kind}": F.when(p > share, gain).otherwise(0.0)})
    found = (counts.withColumn("gain", F.greatest("gain_low", "gain_toxic")).where("gain > 12")
             .orderBy(F.desc("gain"), "feature").limit(CANDIDATES).collect())
    candidates = np.array(sorted(r["feature"] for r in found), np.int64)
    # Certain enough to be a labeller: so many toxic rows and hardly another are no accident in any feature.
    pure = np.array(sorted(r["feature"] for r in found if r["p_toxic"] > 0.97 and r["gain_toxic"] > 35), np.int64)
    wanted = F.array(*[F.lit(int(f)) for f in candidates]) if len(candidates) else F.array().cast("array<int>")
    kept = rows.select("near", "sheet", "votes", F.array_intersect("features", wanted).alias("features")).orderBy("near")
    local = kept.collect()
    n = len(local)
    votes = np.array([r["votes"] for r in local], np.int8)
    sheet = np.array([r["sheet"] for r in local], np.int8)
    at = np.repeat(np.arange(n), [len(r["features"]) for r in local])
    feature = np.array([f for r in local for f in r["features"]], np.int64)
    induced = np.full(n, NOTHING, np.int8)
    induced[at[np.isin(feature, pure)]] = TOXIC
    chance, rates, _ = fit_labellers(np.column_stack([votes, induced, sheet]))
    weights, offset = fit_linear(at, np.searchsorted(candidates, feature), n, len(candidates), 1 - chance[:, FINE])
    used = weights != 0
    return Scorer(candidates[used], weights[used], offset, rates)


def score_documents(docs: DataFrame, scorer: Scorer, keep: tuple[str, ...] = ("doc_id",),
                    name: str = "reject_chance") -> DataFrame:
    """The ``keep`` columns of every row and its chance to be a reject. Texts without words (null, empty) get 0."""
    inner = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(keep)], F.col("text").alias("__text"))
    names = inner.columns[:-1]
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in inner.schema.fields[:-1]] + ["score double"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [scorer.score(read(piece)) for piece in T.pieces(batch.column(batch.num_columns - 1))]
            column = pa.array(np.concatenate([np.zeros(0), *scores]))
            yield pa.RecordBatch.from_arrays(batch.columns[:-1] + [column], names + ["score"])

    return inner.mapInArrow(run, schema).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)],
                                                F.col("score").alias(name))


def drop_rejects(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, sample: int = SAMPLE) -> DataFrame:
    """The documents whose chance to be a reject is below ``threshold``, all columns kept. Rows with equal texts fare
    alike. Documents without words stay."""
    scorer = fit(docs, labels, sample)
    name = "__chance"
    return (score_documents(docs, scorer, tuple(docs.columns), name).where(F.col(name) < threshold)
            .select(*docs.columns))


@query()
def op1_weak_label_quality(spark: SparkSession, folder: str) -> DataFrame:
    """The documents that the classifier keeps, with their scores."""
    docs = table(spark, folder, "documents")
    scorer = fit(docs, table(spark, folder, "labels"))
    return score_documents(docs, scorer).where("reject_chance < 0.5")
