"""Mixing to target weights: soft membership, then document rates by projected gradient.

A naive Bayes classifier over hashed words, learned from a labelled table, gives every document
a probability for each domain. Nonnegative rates of documents are then fitted so that the
expected tokens of each domain, sum(rate * tokens * probability), are its target in the least
squares. Errors are measured in the metric of the domains' Gram matrix, the sum over documents
of tokens * probability * probability': in it a scarce domain counts as much as a common one,
and a step of length 1 never overshoots. The gradient is then the same small vector product for
every document, ``sum(probability * slope)``, where the slopes come from one error per domain.
So a step needs one sum per domain over the corpus, and nothing is kept per document: its rate
is computed again from the slopes so far.
"""

import math
from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplake.llm.common import stored

SAMPLE = 20_000  # labelled documents that are learned from, at most
FEATURES = 8192
SEED = 17
RIDGE = 1e-6  # of the mean domain, added to each: a domain that nothing belongs to moves nothing


def features(text: Column) -> Column:
    """The hashed words of a text, one null for a text without any."""
    found = F.filter(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return F.explode_outer(found)


def digest(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def hashed(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(FEATURES))


def learned(
    docs: DataFrame, labelled: DataFrame, domains: list[str], id_col: str, text_col: str, sample: int
) -> tuple[DataFrame, list[float]]:
    """Log likelihoods by feature (a column per domain), and log priors.

    The labelled rows with the smallest hash of the id are learned from, ``sample`` at most.
    """
    known = labelled.where(F.col("domain").isin(domains) & F.col(id_col).isNotNull())
    known = known.groupBy(F.col(id_col).alias("__id")).agg(F.min("domain").alias("domain"))
    known = known.orderBy(F.xxhash64("__id"), "__id").limit(sample)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("__id"), text.alias("text"))
    # At most ``sample`` rows.
    rows = rows.join(F.broadcast(known), "__id")
    said = rows.select("__id", "domain", features(F.col("text")).alias("word"))
    tallies = [
        F.count_if((F.col("domain") == d) & F.col("word").isNotNull()).alias(f"n{i}") for i, d in enumerate(domains)
    ]
    counts = stored(said.groupBy(hashed(F.col("word")).alias("feature")).agg(*tallies))
    sizes = {r.domain: r["count"] for r in known.groupBy("domain").count().collect()}
    total = sum(sizes.values())
    priors = [math.log((sizes.get(d, 0) + 1) / (total + len(domains))) for d in domains]
    zero = F.lit(0)
    sums = [F.coalesce(F.sum(f"n{i}"), zero) for i in range(len(domains))]
    sums = counts.agg(*sums).first()
    everything = docs.sparkSession.range(FEATURES).select(F.col("id").alias("feature"))
    model = everything.join(counts, "feature", "left").select(
        "feature",
        *[
            F.log((F.coalesce(f"n{i}", F.lit(0)) + 0.5) / (sums[i] + 0.5 * FEATURES)).alias(f"l{i}")
            for i in range(len(domains))
        ],
    )
    return stored(model), priors


def memberships(
    docs: DataFrame, model: DataFrame, priors: list[float], id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, digest, tokens, p0, p1, ...`` for every row; tokens are words."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    # All words of a row are in one task, so they are summed before anything moves.
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).cast("bigint").alias("doc_id"),
        digest(text).alias("digest"),
        text.alias("text"),
    )
    said = rows.select("row", "doc_id", "digest", features(F.col("text")).alias("word"))
    said = said.select("row", "doc_id", "digest", "word", hashed(F.col("word")).alias("feature"))
    # FEATURES rows.
    joined = said.join(F.broadcast(model), "feature", "left")
    n = range(len(priors))
    sums = joined.groupBy("row", "doc_id", "digest").agg(
        F.count("word").alias("tokens"),
        *[F.sum(F.when(F.col("word").isNotNull(), F.col(f"l{i}"))).alias(f"s{i}") for i in n],
    )
    logits = [F.coalesce(F.col(f"s{i}"), F.lit(0.0)) + priors[i] for i in n]
    top = F.greatest(*logits) if len(logits) > 1 else logits[0]
    odds = sums.select("doc_id", "digest", "tokens", *[F.exp(x - top).alias(f"o{i}") for i, x in enumerate(logits)])
    whole = sum((F.col(f"o{i}") for i in n), F.lit(0.0))
    return odds.select("doc_id", "digest", "tokens", *[(F.col(f"o{i}") / whole).alias(f"p{i}") for i in n])


def rate_after(slopes: list[list[float]], start: float, max_rate: float | None) -> Column:
    """A document's rate after steps along these slopes."""
    rate = F.lit(start)
    for step in slopes:
        slope = sum((F.col(f"p{i}") * e for i, e in enumerate(step)), F.lit(0.0))
        rate = F.greatest(F.lit(0.0), rate - slope)
        rate = rate if max_rate is None else F.least(F.lit(max_rate), rate)
    return rate


@dataclass
class Fit:
    """The rate of each row, and the domains' tokens that were wanted and are reached."""

    rate: Column
    wanted: list[float]
    reached: list[float]
    converged: bool
    steps: int


def fitted(
    scored: DataFrame,
    weights: list[float],
    max_rate: float | None = None,
    total: float | None = None,
    steps: int = 40,
    tolerance: float = 1e-3,
) -> Fit:
    """Rates of the rows of ``scored``; converged if no domain is off by more than ``tolerance``
    of what is wanted of it. Steps also end when they lead nowhere."""
    n = range(len(weights))

    def sums(*values: Column) -> list[float]:
        return [float(x or 0.0) for x in scored.agg(*[F.sum(v) for v in values]).first()]

    def totals(rate: Column) -> list[float]:
        return sums(*[F.col("tokens") * F.col(f"p{i}") * rate for i in n])

    pairs = [(i, j) for i in n for j in n if i <= j]
    gram = np.zeros((len(weights), len(weights)))
    for (i, j), value in zip(pairs, sums(*[F.col("tokens") * F.col(f"p{i}") * F.col(f"p{j}") for i, j in pairs])):
        gram[i, j] = gram[j, i] = value
    whole = sum(totals(F.lit(1.0)))
    gram += RIDGE * max(whole, 1.0) / len(weights) * np.eye(len(weights))
    goal = whole if total is None else total
    wanted = [w * goal for w in weights]
    start = goal / whole if whole else 1.0
    start = start if max_rate is None else min(max_rate, start)
    slopes: list[list[float]] = []
    reached = [math.inf] * len(weights)
    while True:
        rate = rate_after(slopes, start, max_rate)
        before, reached = reached, totals(rate)
        still = max(abs(x - y) for x, y in zip(reached, before)) <= tolerance / 100 * goal
        error = np.subtract(reached, wanted)
        done = all(abs(e) <= tolerance * w for e, w in zip(error, wanted))
        if done or still or len(slopes) == steps or not whole:
            return Fit(rate, wanted, reached, done, len(slopes))
        slopes.append(np.linalg.solve(gram, error).tolist())


def mix(
    docs: DataFrame,
    labelled: DataFrame,
    targets: Mapping[str, float],
    id_col: str = "doc_id",
    text_col: str = "text",
    max_rate: float | None = None,
    total: float | None = None,
    sample: int = SAMPLE,
    steps: int = 40,
    tolerance: float = 1e-3,
) -> DataFrame:
    """``doc_id, domain, probability, tokens, rate, copies, target_share, reached_share,
    converged`` for every input row.

    ``labelled`` has the id and ``domain``; ``targets`` the weight of each domain. ``total``
    is how many tokens the mixture shall have, as many as there are by default: what is scarce
    is repeated, at rates above 1, and what is common is thinned out. ``max_rate`` bounds the
    rates; without it they are only not negative. Steps end when every domain is within
    ``tolerance`` of its target, when nothing changes any more, or after ``steps``; ``converged``
    says whether it was the first. A domain that no
    document belongs to stays short, and the others reach their own targets. The shares are
    those of the row's most probable domain in the expected mixture, the target's of ``total``.
    ``copies`` is the rate rounded up or down by a hash of the id, so that its mean is the
    rate. Labels of other domains and without an id play no part; of several labels of an id
    the first by name counts. Null and empty texts have no tokens and the domains' priors as
    membership, as all texts have without any label. Repeated rows get a row each. Other
    columns play no part. No rows in, no rows out.
    """
    return _mixed(docs, labelled, targets, id_col, text_col, max_rate, total, sample, steps, tolerance).drop("digest")


def _mixed(
    docs: DataFrame, labelled: DataFrame, targets: Mapping[str, float], id_col: str = "doc_id",
    text_col: str = "text", max_rate: float | None = None, total: float | None = None,
    sample: int = SAMPLE, steps: int = 40, tolerance: float = 1e-3,
) -> DataFrame:
    """As ``mix``, with the digest of the text; rows of equal id and text have equal rates."""
    domains = sorted(targets)
    weights = [targets[d] / sum(targets.values()) for d in domains]
    model, priors = learned(docs, labelled, domains, id_col, text_col, sample)
    scored = stored(memberships(docs, model, priors, id_col, text_col))
    fit = fitted(scored, weights, max_rate, total, steps, tolerance)
    each = [
        F.struct(F.col(f"p{i}").alias("p"), F.lit(d).alias("d"), F.lit(weights[i]).alias("target"),
                 F.lit(fit.reached[i] / max(sum(fit.reached), 1e-300)).alias("reached"))
        for i, d in enumerate(domains)
    ]
    lowest = [F.lit(-1.0).alias("p"), F.lit("").alias("d"), F.lit(0.0).alias("target"), F.lit(0.0).alias("reached")]
    best = F.greatest(*each, F.struct(*lowest))
    chance = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(2**40)) / F.lit(2**40)
    return scored.select("doc_id", "digest", "tokens", best.alias("best"), fit.rate.alias("rate")).select(
        "doc_id", "digest", F.col("best.d").alias("domain"), F.col("best.p").alias("probability"), "tokens", "rate",
        F.floor(F.col("rate") + chance).cast("bigint").alias("copies"),
        F.col("best.target").alias("target_share"), F.col("best.reached").alias("reached_share"),
        F.lit(fit.converged).alias("converged"),
    )


def drawn(
    docs: DataFrame, labelled: DataFrame, targets: Mapping[str, float], id_col: str = "doc_id",
    max_rate: float | None = None, total: float | None = None,
) -> DataFrame:
    """The documents that the mixture takes, with all their columns, a row for each copy; see
    ``mix``. Rows of equal id and text are taken equally often."""
    mixed = _mixed(docs, labelled, targets, id_col, max_rate=max_rate, total=total).where("copies <> 1")
    # Of rows with equal id and text the rates may differ in their last digits.
    other = mixed.groupBy("doc_id", "digest").agg(F.max("copies").alias("copies"))
    # As one column, so that no name of theirs meets one of these.
    rows = docs.select(
        F.struct("*").alias("row"), F.col(id_col).cast("bigint").alias("id"), digest(F.col("text")).alias("own")
    )
    same = F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("own") == F.col("digest"))
    copies = F.coalesce("copies", F.lit(1)).cast("int")
    taken = rows.join(other, same, "left").select("row", F.explode(F.array_repeat(F.lit(0), copies)))
    return taken.select("row.*")


# The weights that the registered query mixes languages to.
LANGUAGES = {"en": 0.60, "de": 0.15, "fr": 0.15, "es": 0.10}
