"""Document quality by hierarchical empirical Bayes.

A naive Bayes classifier over a dozen measures of a text gives each document its evidence, a
log-likelihood ratio. The documents of a host, and of a path on it, give a beta posterior of
their share of good ones; a site with few documents shrinks towards its parent, the more the
less such shares differ in the whole corpus. A document's score joins its own evidence with
the posterior of its path, from which its own part is taken out.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from dataclasses import dataclass
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthwatt.llm.frames import kept_apart, map_rows, stored, text_or_empty
from hearthwatt.llm.labelled import held_out, training_labels

#: Values a measure is binned to: 0 to BINS - 1.
BINS = 16
#: Weight of the prior of a bin, in documents.
PRIOR = 1.0
#: Measures of one text overlap, so that their ratios sum to too much.
DAMPING = 0.5
#: Documents' worth of a prior at most; shares that don't differ would give no end of it.
MOST_PRIOR = 1000.0

SYMBOLS = frozenset("#$%&*@^~+=<>{}[]\\/_")
RUN = re.compile(r"(.)\1{3,}")


def measures(text: str) -> list[int]:
    """Binned measures of a whole text: shares of words and of characters, and its length."""
    words = text.split()
    n, chars = max(1, len(words)), max(1, len(text))
    marked = sum(w[-1] in SYMBOLS for w in words)
    single = sum(len(w) == 1 and not w.isalnum() for w in words)
    upper = sum(len(w) > 1 and w.isupper() for w in words)
    repeated = n - len(set(words))
    runs = n - sum(1 for _ in groupby(words))
    lines = text.split("\n")
    letters = sum(map(str.isalpha, words))
    shares = [
        marked / n,
        single / n,
        upper / n,
        repeated / n,
        runs / n,
        letters / n,
        text.count("!") / n,
        sum(text.count(c) for c in "|#$%&*") / chars,
        sum(text.count(c) for c in "0123456789") / chars,
        (len(lines) - len(set(lines))) / max(1, len(lines)),
        sum(len(m.group()) for m in RUN.finditer(text)) / chars,
    ]
    return [min(BINS - 1, math.ceil(s * (BINS - 2))) for s in shares] + [
        min(BINS - 1, len(words).bit_length()),
        min(BINS - 1, int(sum(map(len, words)) / n)),
    ]


def measured(df: DataFrame, columns: list[str], text_col: str = "text") -> DataFrame:
    """``columns`` and ``bins`` of every row."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}

    def measure(rows):
        return {c: rows[c] for c in columns} | {"bins": [measures(t) for t in rows[text_col]]}

    schema = ", ".join(f"`{c}` {kinds[c]}" for c in columns) + ", bins array<int>"
    return map_rows(df.select(*columns, text_or_empty(text_col)), measure, schema)


@dataclass(frozen=True)
class QualityModel:
    """Evidence of each bin of each measure, and the share of good documents."""

    ratios: tuple[tuple[float, ...], ...]
    share: float

    def evidence(self) -> Column:
        parts = [
            F.get(F.array(*[F.lit(r) for r in ratios]), F.get("bins", F.lit(k)))
            for k, ratios in enumerate(self.ratios)
        ]
        return sum(parts, F.lit(0.0)) * DAMPING


def train_quality(bins: DataFrame, known: DataFrame, id_col: str = "doc_id") -> QualityModel:
    """Count the bins of the documents whose label is ``known``; a table of a few hundred
    rows comes back, whatever the corpus. Without labels nothing is evidence."""
    known = bins.join(known, id_col)
    counts = (
        known.select("label", F.posexplode("bins").alias("measure", "bin"))
        .groupBy("measure", "bin")
        .agg(F.sum("label").alias("good"), F.sum(1 - F.col("label")).alias("bad"))
        .collect()
    )
    size = len(measures(""))
    good, bad = ([[0.0] * BINS for _ in range(size)] for _ in range(2))
    for row in counts:
        good[row["measure"]][row["bin"]], bad[row["measure"]][row["bin"]] = row["good"], row["bad"]
    all_good, all_bad = sum(good[0]), sum(bad[0])
    share = (all_good + 1) / (all_good + all_bad + 2)

    def ratio(g: float, b: float) -> float:
        # The prior of a bin nothing is known of speaks for neither side.
        return math.log((g + PRIOR * share) / (all_good + PRIOR * share)) - math.log(
            (b + PRIOR * (1 - share)) / (all_bad + PRIOR * (1 - share))
        )

    ratios = tuple(tuple(ratio(g, b) if g + b else 0.0 for g, b in zip(*k, strict=True)) for k in zip(good, bad, strict=True))
    return QualityModel(ratios, share)


def _mean(good, n):
    """The share of good ones among ``n`` documents, half a good and half a bad one added."""
    return (good + 0.5) / (n + 1)


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def _sites(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Number and sum of good documents of each site; partial sums within tasks first, so a
    site with a third of all documents is no single task's work."""
    return rows.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("good").alias("good"))


def _prior_weight(sites: DataFrame, parent: Column) -> float:
    """How many documents the parent's share is worth, from how site shares scatter about it
    beyond what sampling alone would give (method of moments)."""
    p = F.col("good") / F.col("n")
    noise = parent * (1 - parent) / F.col("n")
    found = sites.agg(
        F.sum(F.col("n") * ((p - parent) ** 2 - noise)).alias("scatter"),
        F.sum(F.col("n") * parent * (1 - parent)).alias("spread"),
        F.sum("n").alias("n"),
    ).first()
    if not found["n"] or found["scatter"] is None or found["scatter"] <= 0:
        return MOST_PRIOR
    return min(MOST_PRIOR, max(1.0, found["spread"] / found["scatter"] - 1))


def score_quality(
    df: DataFrame,
    labels: DataFrame,
    host: Callable[[], Column],
    path: Callable[[], Column],
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per row of ``df``: its id, the ``keep`` columns, ``held_out``, ``evidence``,
    ``host_posterior``, ``path_posterior``, ``score`` (of being good) and ``keep`` (a score of one
    half or more).

    A document's own part is left out of its path, its host and the corpus, so its label never
    speaks for itself. Held-out labels are never used; the other ones count in their sites in
    place of what the classifier says. A null text is an empty one, a long one is measured whole.
    Rows without host or path form sites of their own. Rows that repeat, or share an id, are
    documents each; they take the label of their id. A kept column called as a result is left
    out. An empty table gives no rows.
    """
    results = ("held_out", "evidence", "host_posterior", "path_posterior", "score", "keep")
    names = kept_apart([id_col, *[c for c in keep if c not in (id_col, *results)]])
    held = list(names.values())
    placed = df.select(
        *[F.col(c).alias(r) for c, r in names.items()],
        F.coalesce(host().cast("string"), F.lit("")).alias("host"),
        F.coalesce(path().cast("string"), F.lit("")).alias("path"),
        F.col(text_col).alias("text"),
    )
    bins = stored(measured(placed, [*held, "host", "path"]), "bins")
    known = stored(training_labels(labels, "quality", id_col).withColumnRenamed(id_col, held[0]), "quality-labels")
    model = train_quality(bins, known, id_col=held[0])
    judged = bins.select(*held, "host", "path", model.evidence().alias("evidence")).join(known, held[0], "left")
    prior = math.log(model.share / (1 - model.share))
    judged = judged.withColumn("good", F.coalesce("label", 1 / (1 + F.exp(-(F.col("evidence") + prior)))))
    judged = stored(judged.drop("label"), "judged")

    paths = stored(_sites(judged.withColumn("n", F.lit(1)), ["host", "path"]), "paths")
    hosts = stored(_sites(paths, ["host"]), "hosts")
    total = hosts.agg(F.sum("good").alias("good"), F.sum("n").alias("n")).first()
    good, n = total["good"] or 0.0, total["n"] or 0
    host_weight = _prior_weight(hosts, F.lit(_mean(good, n)))
    below = paths.join(hosts.select("host", F.col("n").alias("host_n"), F.col("good").alias("host_good")), "host")
    below = stored(below, "sites")
    host_share = (F.col("host_good") + host_weight * _mean(good, n)) / (F.col("host_n") + host_weight)
    path_weight = _prior_weight(below, host_share)

    sites = below.select("host", "path", "host_n", "host_good", F.col("n").alias("site_n"), F.col("good").alias("site_good"))
    scored = judged.join(sites, ["host", "path"])
    own = F.col("good")
    mean = _mean(F.lit(good) - own, n - 1)
    scored = scored.withColumn(
        "host_posterior", (F.col("host_good") - own + host_weight * mean) / (F.col("host_n") - 1 + host_weight)
    )
    others = (F.col("site_good") - own + path_weight * F.col("host_posterior")) / (F.col("site_n") - 1 + path_weight)
    scored = scored.withColumn("path_posterior", F.least(F.greatest(others, F.lit(1e-3)), F.lit(1 - 1e-3)))
    score = 1 / (1 + F.exp(-(F.col("evidence") + _logit(F.col("path_posterior")))))
    return scored.select(
        *[F.col(r).alias(c) for c, r in names.items()],
        held_out(held[0]).alias("held_out"),
        "evidence",
        "host_posterior",
        "path_posterior",
        score.alias("score"),
        (score >= 0.5).cast("int").alias("keep"),
    )
