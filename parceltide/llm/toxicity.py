"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives, all other training texts are
unlabelled: some of them are toxic too. The risk of a classifier g under class
prior p is estimated as

    p * R+(positives)  +  max(0, R-(unlabelled) - p * R-(positives))

with the logistic loss; where the second term would turn negative, the step goes
against it instead (Kiryo et al., 2017). Several linear numpy classifiers over
hashed words see different unlabelled portions; their weights are averaged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from parceltide.llm.bytes_math import Joined, byte_table, lower_ascii, run_hashes, text_chunks

WORD_BYTES = byte_table((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
HELD_OUT_OF = 5  # documents with crc32(id) mod 5 = 0 are never learnt from


@dataclass(frozen=True)
class Settings:
    """``most_positive`` and ``most_unlabelled`` bound the fitted sample, in rows; ``slots`` the features."""

    most_positive: int = 5_000
    most_unlabelled: int = 12_000
    slots: int = 1 << 18
    classifiers: int = 3
    steps: int = 300
    rate: float = 0.5
    momentum: float = 0.9
    decay: float = 1e-4
    least_documents: int = 10  # a word in fewer sampled documents has no weight,
    most_share: float = 0.3  # nor one in more than this share of them


@dataclass
class Model:
    weights: np.ndarray
    bias: float


def word_slots(texts: list[bytes], slots: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, slot) pairs, each once, ordered by text."""
    joined = Joined(texts)
    joined.buffer = lower_ascii(joined.buffer)
    starts, ends = joined.runs(WORD_BYTES)
    slot = (run_hashes(joined.buffer, starts, ends) % np.uint64(slots)).astype(np.int64)
    pairs = np.unique(joined.owner(starts) * slots + slot)
    return pairs // slots, pairs % slots


def held_out(id_column: str = "doc_id") -> F.Column:
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % HELD_OUT_OF == 0, F.lit(False))


def _features(slots: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in text_chunks(batch.column(1)):
                owner, slot = word_slots(texts, slots)
                cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
                packed = [slot[a:b].astype(np.int32).tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), pa.array(packed, pa.binary())], ["positive", "slots"]
                )

    return run


def training_sample(
    docs: DataFrame, labels: DataFrame, settings: Settings, id_column: str = "doc_id", text_column: str = "text"
) -> tuple[list[np.ndarray], list[np.ndarray], float]:
    """Slots of the positives, slots of the unlabelled, class prior.

    Rows are taken by the order of a hash of their id, up to the bounds; held-out
    rows and rows with a null id or label are left out.
    """
    known = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    prior = known.agg(F.avg(F.col("toxic").cast("double"))).first()[0] or 0.0
    order = F.xxhash64("doc_id")
    ids = docs.where(F.col(id_column).isNotNull() & ~held_out(id_column)).select(F.col(id_column).alias("doc_id"))
    positive = known.where("toxic = 1").select("doc_id").orderBy(order).limit(settings.most_positive)
    unlabelled = ids.orderBy(F.xxhash64(F.lit(2), "doc_id")).limit(settings.most_unlabelled)
    chosen = positive.withColumn("positive", F.lit(True)).union(unlabelled.withColumn("positive", F.lit(False)))
    rows = (
        docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
        .join(F.broadcast(chosen), "doc_id")  # bounded by the two settings
        .select("positive", "text")
        .mapInArrow(_features(settings.slots), "positive boolean, slots binary")
        .collect()
    )
    parts = {kind: [np.frombuffer(r.slots, np.int32) for r in rows if r.positive is kind] for kind in (True, False)}
    return parts[True], parts[False], float(prior)


class _Rows:
    """Presence features of some documents, ready for scores and gradients."""

    def __init__(self, rows: list[np.ndarray], usable: np.ndarray):
        rows = [r[usable[r]] for r in rows]
        self.n = len(rows)
        self.slots = np.concatenate(rows) if rows else np.zeros(0, np.int32)
        self.owner = np.repeat(np.arange(self.n), [len(r) for r in rows])

    def scores(self, weights: np.ndarray, bias: float) -> np.ndarray:
        return np.bincount(self.owner, weights=weights[self.slots], minlength=self.n) + bias

    def pull(self, per_row: np.ndarray, slots: int) -> np.ndarray:
        return np.bincount(self.slots, weights=per_row[self.owner], minlength=slots)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


def fit_pu(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, settings: Settings) -> Model:
    """One classifier by full-batch gradient steps with momentum on the non-negative risk.

    Steps are plain, not scaled word by word: words that tell much move far, and
    the many rare ones that only fit the sample hardly move.
    """
    counts = np.bincount(np.concatenate([*positive, *unlabelled]), minlength=settings.slots)
    usable = (counts >= settings.least_documents) & (counts <= settings.most_share * (len(positive) + len(unlabelled)))
    pos, unl = _Rows(positive, usable), _Rows(unlabelled, usable)
    weights = np.zeros(settings.slots + 1)  # the last one is the bias
    weights[-1] = np.log(prior / (1 - prior))
    speed = np.zeros_like(weights)
    for _ in range(settings.steps):
        sp, su = pos.scores(weights, weights[-1]), unl.scores(weights, weights[-1])
        # losses: positive log(1 + e^-s), negative log(1 + e^s)
        negative_part = np.logaddexp(0, su).mean() - prior * np.logaddexp(0, sp).mean()
        up, un = prior * _sigmoid(sp) / pos.n, _sigmoid(su) / unl.n
        if negative_part >= 0:
            to_pos, to_unl = -prior * _sigmoid(-sp) / pos.n - up, un
        else:
            to_pos, to_unl = up, -un
        slope = pos.pull(to_pos, settings.slots) + unl.pull(to_unl, settings.slots)
        slope = np.append(slope + settings.decay * weights[:-1], to_pos.sum() + to_unl.sum())
        speed = settings.momentum * speed + slope
        weights -= settings.rate * speed
    return Model(weights[:-1], float(weights[-1]))


def fit(
    docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), id_column: str = "doc_id", text_column: str = "text"
) -> Model:
    """The averaged model; without any positive example a constant score of the prior (0 without labels)."""
    positive, unlabelled, prior = training_sample(docs, labels, settings, id_column, text_column)
    if not positive or not unlabelled or not 0 < prior < 1:
        return Model(np.zeros(settings.slots), float(np.log(max(prior, 1e-9) / max(1 - prior, 1e-9))))
    many = max(1, min(settings.classifiers, len(unlabelled)))
    models = [fit_pu(positive, unlabelled[k::many], prior, settings) for k in range(many)]
    return Model(np.mean([m.weights for m in models], axis=0), float(np.mean([m.bias for m in models])))


def _scoring(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = shared.value
        for batch in batches:
            for first, texts in text_chunks(batch.column(1)):
                owner, slot = word_slots(texts, len(weights))
                logits = np.bincount(owner, weights=weights[slot], minlength=len(texts)) + bias
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), batch.column(1).slice(first, len(texts)),
                     pa.array(_sigmoid(logits))],
                    ["id", "text", "score"],
                )

    return run


def scores(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, text, score) of every row; null and empty texts get the score of no words."""
    kind = docs.schema[id_column].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))  # one number per slot
    return docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).mapInArrow(
        _scoring(shared), f"id {kind}, text string, score double"
    )


def without_toxic(
    docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is below one half."""
    model = fit(docs, labels, settings, id_column, text_column)
    narrow = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text_column).alias("text")
    )
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))
    schema = T.StructType([
        T.StructField("id", narrow.schema["row"].dataType), T.StructField("text", T.StringType()),
        T.StructField("score", T.DoubleType()),
    ])
    return narrow.mapInArrow(_scoring(shared), schema).where("score < 0.5").select(
        *[F.col("id")[c].alias(c) for c in docs.columns]
    )
