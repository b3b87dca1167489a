"""Toxic passages by maximum-scoring segments of token log-odds.

Training counts in how many toxic and other documents each token occurs. Its log-odds ratio
under Dirichlet priors, with its variance, says how surely it speaks for toxicity. A document
is a sequence of such scores; other tokens cost a little each. A linear scan finds all maximal
segments, whose scores are put in units of the extreme-value law that the best segment of a
clean document follows. These units, over all significant passages, give the probability.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from hearthwatt.llm.frames import find_package, kept_apart, map_rows, stored, text_or_empty
from hearthwatt.llm.labelled import bounded_sample, held_out, training_labels

#: Labelled documents that the model learns from, at most; a fifth of them calibrate it.
TRAINING_DOCUMENTS = 50_000
#: A token enters the model if its log-odds ratio is so many standard errors above zero.
SURE = 3.0
#: Weight of the prior, in tokens.
PRIOR = 500.0
#: What any other token takes from a passage.
COST = 0.05
#: Chance passages as good as a significant one in a clean document of its length.
EXPECTED = 0.05
MAX_UNITS = 60.0
EULER = 0.5772156649

TOKEN = re.compile(r"\w+")


@dataclass(frozen=True)
class ToxicityModel:
    """Token scores, the extreme-value law of clean documents, and the final weights."""

    scores: dict[str, float]
    cost: float
    scale: float
    log_k: float
    weights: tuple[float, float, float]


def tokens(text: str) -> list[str]:
    return TOKEN.findall(text.lower())


def segments(hits: list[tuple[int, float]], cost: float) -> list[tuple[float, int, int]]:
    """All maximal-scoring segments as (score, first, last token), in order, in linear time.

    ``hits`` are positions and positive scores; every token between two hits costs ``cost``.
    A segment is maximal if no part beside it adds to its score and none of it is a drag. Each
    candidate remembers the nearest one on its left with a smaller sum before it.
    """
    found: list[tuple[float, float, int, int, int]] = []  # sum before, sum after, first, last, left
    total, before = 0.0, -1
    for place, score in hits:
        total -= cost * (place - before - 1)
        low, high, first = total, total + score, place
        total, before = high, place
        left = len(found) - 1
        while True:
            while left >= 0 and found[left][0] >= low:
                left = found[left][4]
            if left < 0 or found[left][1] >= high:
                break
            low, first, further = found[left][0], found[left][2], found[left][4]
            del found[left:]
            left = further
        found.append((low, high, first, place, left))
    return [(high - low, first, last) for low, high, first, last, _ in found]


def hits(words: list[str], scores: dict[str, float]) -> list[tuple[int, float]]:
    return [(i, scores[w]) for i, w in enumerate(words) if w in scores]


def units(found: list[tuple[float, int, int]], length: int, model: ToxicityModel) -> list[float]:
    """Scores as -ln of the expected number of chance segments as good, per segment."""
    return [model.scale * score - model.log_k - math.log(max(1, length)) for score, _, _ in found]


def features(text: str, model: ToxicityModel) -> tuple[float, float]:
    """Units of the best passage, and of all significant passages together."""
    words = tokens(text)
    found = units(segments(hits(words, model.scores), model.cost), len(words), model)
    best = max(found, default=-MAX_UNITS)
    significant = sum(u for u in found if u > -math.log(EXPECTED))
    return min(MAX_UNITS, max(-MAX_UNITS, best)) / 10, math.log1p(significant)


def probability(text: str, model: ToxicityModel) -> float:
    bias, one, two = model.weights
    best, all_of_them = features(text, model)
    return 1 / (1 + math.exp(-max(-50.0, min(50.0, bias + one * best + two * all_of_them))))


def _token_counts(documents: DataFrame) -> DataFrame:
    """Weighted numbers of toxic and of all documents for each token; summed within a task
    before the shuffle, in parts of bounded size."""

    schema = "token string, toxic double, n double"
    target = to_arrow_schema(StructType.fromDDL(schema))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic, every = Counter(), Counter()
        for batch in batches:
            rows = batch.to_pydict()
            for text, label in zip(rows["text"], rows["label"], strict=True):
                present = set(tokens(text))
                every.update(present)
                toxic.update(dict.fromkeys(present, label) if label else ())
            if len(every) > 200_000:
                yield part(toxic, every)
                toxic, every = Counter(), Counter()
        yield part(toxic, every)

    def part(toxic: Counter, every: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(
            {"token": list(every), "toxic": [float(toxic[w]) for w in every], "n": [float(n) for n in every.values()]},
            schema=target,
        )

    find_package(documents.sparkSession)
    parts = documents.select("text", "label").mapInArrow(count, schema)
    return parts.groupBy("token").agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n"))


def _log_odds(counts: DataFrame) -> DataFrame:
    """The log-odds ratio of each token with its standard error.

    A token's prior is one document and its share of ``PRIOR``, split between the two sides as
    all documents' tokens are, so that a token which nothing is known of has a ratio of zero.
    """
    totals = counts.agg(F.sum("toxic").alias("t"), F.sum("n").alias("all")).first()
    every = totals["all"] or 0.0
    share = (totals["t"] or 0.0) / max(1.0, every)
    if not 0 < share < 1:
        return counts.limit(0).selectExpr("token", "0D odds", "1D error", "0D clean_share")
    prior = 1 + PRIOR * F.col("n") / every
    toxic, clean = F.col("toxic") + prior * share, F.col("n") - F.col("toxic") + prior * (1 - share)
    all_toxic, all_clean = (every + PRIOR) * share, (every + PRIOR) * (1 - share)
    ratio = F.log(toxic / (all_toxic - toxic)) - F.log(clean / (all_clean - clean))
    return counts.select(
        "token",
        ratio.alias("odds"),
        F.sqrt(1 / toxic + 1 / clean).alias("error"),
        (clean / all_clean).alias("clean_share"),
    )


def _scale(scores: np.ndarray, shares: np.ndarray, cost: float) -> float:
    """The positive root of E[exp(x score)] = 1 for a token of a clean document."""
    if not len(scores):
        return 1.0
    rest = max(1e-9, 1 - shares.sum())
    low, high = 0.0, 50.0
    for _ in range(100):
        x = (low + high) / 2
        value = (shares * np.exp(np.minimum(700, x * scores))).sum() + rest * math.exp(-x * cost)
        low, high = (x, high) if value < 1 else (low, x)
    return max(1e-3, low)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights of a logistic regression by Newton's method, the first for the constant."""
    design, weights = np.column_stack([np.ones(len(x)), x]), np.zeros(x.shape[1] + 1)
    penalty = np.diag([0.01] + [ridge] * x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))
        hessian = (design * (p * (1 - p))[:, None]).T @ design + penalty
        step = np.linalg.solve(hessian, design.T @ (y - p) - penalty @ weights)
        weights += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return weights


def train_toxicity(
    documents: DataFrame,
    labels: DataFrame,
    training_documents: int = TRAINING_DOCUMENTS,
    label: str = "toxic",
    id_col: str = "doc_id",
    text_col: str = "text",
) -> ToxicityModel:
    """Learn from at most about ``training_documents`` labelled documents that are not held out.

    Equal texts count as one with their mean label. Without any usable label, or of one kind
    only, all texts score alike: the share of toxic labels, or one half without labels.
    """
    chosen = bounded_sample(training_labels(labels, label, id_col), training_documents, id_col)
    texts = documents.select(F.col(id_col), text_or_empty(text_col).alias("text"))
    # The sample's bound is also that of what is broadcast.
    marked = texts.join(F.broadcast(chosen), id_col).withColumn("copy", F.xxhash64("text"))
    once = stored(
        marked.groupBy("copy").agg(F.min(id_col).alias(id_col), F.avg("label").alias("label")), "training-ids"
    )
    # An id may repeat with many texts; beyond the sample's bound both sides are shuffled.
    wanted = once.select(id_col, "label", "copy")
    wanted = F.broadcast(wanted) if once.count() <= 2 * training_documents else wanted
    known = stored(
        texts.join(wanted, id_col)
        .where(F.xxhash64("text") == F.col("copy"))
        .dropDuplicates(["copy"]),
        "training",
    )
    fold = F.pmod("copy", F.lit(5))
    odds = stored(_log_odds(stored(_token_counts(known.where(fold != 0)), "tokens")), "odds")
    sure = odds.where(F.col("odds") > SURE * F.col("error")).orderBy(
        (F.col("odds") / F.col("error")).desc(), "token"
    )
    # All of them: their number is bounded by the sample they come from.
    lexicon = sure.collect()
    scores = {r["token"]: float(r["odds"]) for r in lexicon}
    mass = float(sum(r["clean_share"] * r["odds"] for r in lexicon))
    cost = max(COST, 2 * mass)
    shares = np.array([r["clean_share"] for r in lexicon])
    scale = _scale(np.array(list(scores.values())), shares, cost)

    def measured(model: ToxicityModel):
        shipped = documents.sparkSession.sparkContext.broadcast(model)

        def measure(rows):
            found = [features(t, shipped.value) for t in rows["text"]]
            return {"label": rows["label"], "best": [a for a, _ in found], "all": [b for _, b in found], "n": [len(tokens(t)) for t in rows["text"]]}

        held = known.where(fold == 0).select("text", "label")
        rows = map_rows(held, measure, "label double, best double, all double, n long").collect()
        return np.array([tuple(r) for r in rows], float).reshape(-1, 4)

    plain = ToxicityModel(scores, cost, scale, 0.0, (0.0, 0.0, 0.0))
    seen = measured(plain)
    if not len(seen):
        return plain
    chance = seen[(seen[:, 0] < 0.5) & (seen[:, 1] > -MAX_UNITS / 10)]
    log_k = float(chance[:, 1].mean() * 10 - EULER) if len(chance) >= 30 else math.log(0.1)
    law = ToxicityModel(scores, cost, scale, log_k, (0.0, 0.0, 0.0))
    seen = measured(law)
    weights = _logistic(seen[:, 1:3], seen[:, 0])
    return ToxicityModel(scores, cost, scale, log_k, tuple(float(w) for w in weights))


def score_toxicity(
    df: DataFrame,
    model: ToxicityModel,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """The id, the ``keep`` columns as they are, ``held_out``, ``score``, ``predicted`` and the
    significant ``passages`` (token places and units) of every text, one row per row.

    Texts are scored whole, however long. A null text is an empty one, which scores as a text
    without evidence. Nothing but the text has a part in the score, so repeated rows score alike;
    a null id is not held out. A kept column called as a result is left out. An empty table gives
    no rows."""
    shipped = df.sparkSession.sparkContext.broadcast(model)
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    results = ("held_out", "score", "predicted", "passages")
    names = kept_apart([id_col, *[c for c in keep if c not in (id_col, *results)]])

    def score(rows):
        law, out = shipped.value, []
        texts = [t or "" for t in rows["text"]]
        for text in texts:
            words = tokens(text)
            found = segments(hits(words, law.scores), law.cost)
            rated = zip(found, units(found, len(words), law), strict=True)
            out.append([{"first": a, "last": b, "units": u} for (_, a, b), u in rated if u > -math.log(EXPECTED)])
        found = {"score": [probability(t, law) for t in texts], "passages": out}
        return {c: rows[c] for c in names.values()} | found

    schema = ", ".join(f"{r} {kinds[c]}" for c, r in names.items())
    schema += ", score double, passages array<struct<first: int, last: int, units: double>>"
    picked = df.select(*[F.col(c).alias(r) for c, r in names.items()], F.col(text_col).alias("text"))
    scored = map_rows(picked, score, schema)
    return scored.select(
        *[F.col(r).alias(c) for c, r in names.items()],
        held_out(names[id_col]).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "passages",
    )
