"""Document quality from the text itself and from the site that it comes from.

A logistic model of plain text features, fitted on a bounded sample of labelled documents, gives
each document's evidence.  Hosts and paths get posterior rates of good documents by empirical
Bayes: a path is drawn towards its host and a host towards the whole, the more so the fewer
documents it has.  A document's posterior joins its evidence with the rate of its path.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordat.llm.bytescan import BLOCK, Texts, blocks, mixed, words
from concordat.llm.common import release, releasing, staged, text_or_empty

# Labelled documents that the model is fitted on, at most: those with the smallest hashes.
SAMPLE = 8000
# Posterior from which a document stays.
STAYS = 0.5
_EXTREME = 0.005  # rates of sites are kept this far from 0 and 1
_ASCII = 128


def _features(block: Texts) -> np.ndarray:
    """For each text: shares of the bytes, of distinct and of repeated words, and sizes."""
    number, sizes = block.number, np.diff(block.offsets)
    owner = np.repeat(np.arange(number), sizes)
    kinds = np.minimum(block.data, _ASCII).astype(np.int64)
    counts = np.bincount(owner * (_ASCII + 1) + kinds, minlength=number * (_ASCII + 1))
    shares = counts.reshape(number, -1) / np.maximum(sizes, 1)[:, None]
    found = words(block)
    many = np.bincount(found.texts, minlength=number)
    distinct = np.zeros(number)
    again = np.zeros(number)
    if len(found.texts):
        keys = np.sort(found.hashes ^ mixed(found.texts + 1))
        # A word's key is unlike that of the same word elsewhere, so sorting finds each text's own.
        order = np.argsort(found.hashes ^ mixed(found.texts + 1), kind="stable")
        fresh = np.append(True, keys[1:] != keys[:-1])
        distinct = np.bincount(found.texts[order][fresh], minlength=number)
        same = (found.hashes[1:] == found.hashes[:-1]) & (found.texts[1:] == found.texts[:-1])
        again = np.bincount(found.texts[1:][same], minlength=number)
    least = np.maximum(many, 1)
    more = [np.log1p(distinct) / np.log1p(least), again / least, np.log1p(many), sizes / least / 8]
    return np.column_stack([shares, *more])


def features(column: pa.Array) -> np.ndarray:
    # A quarter of a block: its tables take some 70 bytes for each byte of text, in every task.
    found = [_features(block) for block in blocks(column, BLOCK // 4)]
    return np.concatenate(found) if found else np.zeros((0, _ASCII + 5))


@dataclass
class Model:
    """A logistic model on standardised features; ``prior`` is the sample's log odds."""

    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    prior: float

    def evidence(self, found: np.ndarray) -> np.ndarray:
        """Log likelihood ratio of good against bad, without the sample's prior."""
        scaled = np.clip((found - self.centre) / self.scale, -6, 6)
        return scaled @ self.weights[1:] + self.weights[0] - self.prior


def fit(found: np.ndarray, good: np.ndarray, ridge: float = 1.0, steps: int = 25) -> Model:
    """Newton's method with a ridge.  Without both kinds of label no evidence is ever found."""
    width = found.shape[1] if found.ndim == 2 and len(found) else _ASCII + 5
    if not len(good) or good.min() == good.max():
        return Model(np.zeros(width), np.ones(width), np.zeros(width + 1), 0.0)
    centre, scale = found.mean(0), found.std(0) + 1e-4
    x = np.column_stack([np.ones(len(found)), np.clip((found - centre) / scale, -6, 6)])
    weights = np.zeros(width + 1)
    penalty = np.diag([1e-6] + [ridge] * width)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (good - p) - penalty @ weights
        bend = (x * (p * (1 - p))[:, None]).T @ x + penalty
        step = np.linalg.solve(bend, slope)
        weights += step
        if np.abs(step).max() < 1e-6:
            break
    share = good.mean()
    return Model(centre, scale, weights, float(np.log(share / (1 - share))))


def trained(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """The model of at most ``sample`` labelled documents, chosen by the hash of their id."""
    marked = labels.where("quality in (0, 1) and doc_id is not null").select("doc_id", "quality")
    chosen = marked.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(sample)
    texts = docs.select("doc_id", text_or_empty().alias("text"))
    # ``chosen`` has at most ``sample`` rows of two numbers.
    known = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "quality", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.array(list(features(batch.column(2))), pa.list_(pa.float64()))
            columns = [batch.column(0), batch.column(1).cast(pa.float64()), rows]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "quality", "found"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = known.mapInArrow(releasing(run), f"doc_id {kind}, quality double, found array<double>")
    drawn = rows.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(sample).toArrow()
    found = np.array(drawn["found"].to_pylist(), float)
    return fit(found, drawn["quality"].to_numpy())


def evidence(model: Model, text: Column) -> Column:
    @F.arrow_udf("double")
    def of(column: pa.Array) -> pa.Array:
        found = pa.array(model.evidence(features(column)))
        release()
        return found

    return of(F.coalesce(text, F.lit("")))


def _log_odds(rate: Column) -> Column:
    held = F.least(F.greatest(rate, F.lit(_EXTREME)), F.lit(1 - _EXTREME))
    return F.log(held / (1 - held))


def _concentration(groups: DataFrame, centre: str) -> float:
    """How many documents' worth a group's prior is, by the method of moments.

    ``groups`` has ``n``, ``good`` and the rate ``centre`` that they scatter around.  Scatter beyond
    that of chance makes the prior weak.
    """
    rate = F.col("good") / F.col("n")
    total = groups.agg(
        F.count("*").alias("groups"),
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.col("n")).alias("squares"),
        F.sum(F.col("n") * F.pow(rate - F.col(centre), F.lit(2))).alias("scatter"),
        F.sum(F.col("n") * F.col(centre) * (1 - F.col(centre))).alias("chance"),
    ).first()
    if not total.n:
        return 1.0
    chance = total.chance / total.n
    room = max(total.n - total.squares / total.n, 1e-9)
    between = (total.scatter - max(total.groups - 1, 0) * chance) / room
    return float(min(max(chance / max(between, 1e-9) - 1, 1.0), 1e6))


def site_rates(scored: DataFrame) -> DataFrame:
    """``host``, ``path`` and ``rate``: each path's posterior rate of good documents.

    ``scored`` has ``host``, ``path`` and ``p``.  All counts are grouped sums, combined before the
    shuffle; only three sums of the whole are fetched.
    """
    paths = staged(
        scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("good")), "paths"
    )
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    whole = hosts.agg((F.sum("good") / F.sum("n")).alias("rate")).first().rate
    hosts = hosts.withColumn("whole", F.lit(whole).cast("double"))
    weight = _concentration(hosts, "whole")
    host_rate = (F.col("good") + weight * F.col("whole")) / (F.col("n") + weight)
    drawn = hosts.select(F.col("host").alias("of"), host_rate.alias("host_rate"))
    inside = staged(
        paths.join(drawn, F.col("host").eqNullSafe(F.col("of"))).drop("of"), "paths"
    )
    weight = _concentration(inside, "host_rate")
    rate = (F.col("good") + weight * F.col("host_rate")) / (F.col("n") + weight)
    return staged(inside.select("host", "path", rate.alias("rate")), "sites")


def _with_rates(scored: DataFrame, rates: DataFrame) -> DataFrame:
    rates = rates.select(F.col("host").alias("of"), F.col("path").alias("below"), "rate")
    same = F.col("host").eqNullSafe(F.col("of")) & F.col("path").eqNullSafe(F.col("below"))
    odds = F.col("evidence") + _log_odds(F.col("rate"))
    return (
        scored.join(rates, same, "left")
        .drop("of", "below")
        .withColumn("posterior", 1 / (1 + F.exp(-odds)))
        .withColumn("kept", F.col("posterior") >= STAYS)
    )


def _scored(docs: DataFrame, model: Model, *more: Column) -> DataFrame:
    return docs.select(
        *more,
        F.col("source").alias("host"),
        F.col("lang").alias("path"),
        evidence(model, F.col("text")).alias("evidence"),
    )


def _rates(scored: DataFrame, model: Model) -> DataFrame:
    chance = 1 / (1 + F.exp(-(F.col("evidence") + F.lit(model.prior))))
    return site_rates(scored.select("host", "path", chance.alias("p")))


def judge_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each row of ``docs``: evidence, its path's rate, the posterior and ``kept``.

    ``docs`` has ``doc_id``, ``text``, ``lang`` and ``source``: the source is the host and the
    language its path.  ``labels`` has ``doc_id`` and ``quality`` (1 good, 0 bad; others are passed
    over).  A missing text counts as empty, a missing source or language is a site of its own.
    Repeated rows stay repeated and count as often in their sites.  Without labels of both kinds
    there is no evidence and everything is kept.  An empty table gives an empty result.
    """
    model = trained(docs, labels)
    scored = staged(_scored(docs, model, F.col("doc_id")), "evidence")
    return _with_rates(scored, _rates(scored, model))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``judge_quality`` keeps, whole and with all their columns.

    Evidence is found twice, which is cheaper than to shuffle or store the texts.
    """
    model = trained(docs, labels)
    rates = _rates(_scored(docs, model), model)
    row = F.struct(*docs.columns).alias("row")
    judged = _with_rates(_scored(docs, model, row), rates)
    return judged.where("kept").select(*[F.col(f"row.`{name}`") for name in docs.columns])
