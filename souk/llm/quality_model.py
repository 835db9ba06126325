"""Quality by importance resampling with hashed n-gram models.

Two generative models share one set of hashed word n-grams: the raw model counts all documents, the
target model the labelled good ones. A document's importance is the ratio of its probabilities in the
two, so its logarithm is the sum over all n-grams; Gumbel noise, fixed by the id, turns
the ``k`` largest perturbed importances into a sample without replacement. By default
``k`` is the labelled share of good documents, so that documents like the target are kept.

The target model takes at most ``MAX_TARGETS`` labelled documents, chosen by a hash of their id; all
statistics of the raw text and all scores cover all documents.

Defined results: texts without words have the smallest importance (``LOWEST``); ties go to the smaller id;
labels without a document are ignored and a document labelled twice is good if any label
says so; without labels all importances are equal; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.llm.common import (
    U64, corpus, kth_largest, mixed, numbers, prefix_sums, slices, span_hashes, stored, word_spans,
)

BUCKETS = 1 << 16
MAX_TARGETS = 20_000
SMOOTHING = 1.0
LOWEST = -1e12
SEED, NOISE_SEED = 17, 18  # the draw of the target documents and the noise must not depend on each other


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words and word pairs, with the number of their text."""
    starts, ends, doc = word_spans(data, offsets)
    hashes = span_hashes(prefix_sums(data), starts, ends)
    same = doc[:-1] == doc[1:]
    pairs = mixed(hashes[:-1] * U64(0x9E3779B97F4A7C15) + hashes[1:])[same]
    bucket = np.concatenate([hashes, pairs]) % U64(BUCKETS)
    return bucket.astype(np.int64), np.concatenate([doc, doc[:-1][same]])


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bucket counts of raw and of target text, one row per bucket and task."""
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch, data, offsets in slices(batches):
        bucket, doc = features(data, offsets)
        good = numbers(batch, "good").astype(bool)
        raw += np.bincount(bucket, minlength=BUCKETS)
        target += np.bincount(bucket[good[doc]], minlength=BUCKETS)
    used = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(raw[used]), pa.array(target[used])], ["bucket", "raw", "target"])


def log_ratios(docs: DataFrame, labels: DataFrame, max_targets: int = MAX_TARGETS) -> np.ndarray:
    """log(target / raw) of every bucket."""
    good = labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct()
    good = stored(good.withColumn("draw", F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 52))), "good")
    least, _ = kth_largest(good, "draw", max_targets)
    chosen = good.where(F.col("draw") >= (least or 0)).select("doc_id", F.lit(True).alias("good"))
    flagged = corpus(docs).join(F.broadcast(chosen), "doc_id", "left").select("text", F.coalesce("good", F.lit(False)).alias("good"))
    sums = flagged.mapInArrow(_counts, "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw"), F.sum("target"))
    table = np.array([tuple(r) for r in sums.collect()], np.int64).reshape(-1, 3)  # BUCKETS rows at most
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    raw[table[:, 0]], target[table[:, 0]] = table[:, 1], table[:, 2]
    if not target.any():
        return np.zeros(BUCKETS)
    share = lambda x: (x + SMOOTHING) / (x.sum() + SMOOTHING * BUCKETS)
    return np.log(share(target)) - np.log(share(raw))


def importances(docs: DataFrame, ratios: np.ndarray) -> DataFrame:
    """``doc_id``, ``log_weight`` and the Gumbel-perturbed ``sample_key``."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in slices(batches):
            n = batch.num_rows
            bucket, doc = features(data, offsets)
            size = np.bincount(doc, minlength=n)
            weight = np.where(size > 0, np.bincount(doc, ratios[bucket], n), LOWEST)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(weight)], ["doc_id", "log_weight"])

    weights = corpus(docs).mapInArrow(score, "doc_id long, log_weight double")
    uniform = (F.pmod(F.xxhash64("doc_id", F.lit(NOISE_SEED)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    return weights.withColumn("sample_key", F.col("log_weight") - F.log(-F.log(uniform)))


def sample_by_importance(docs: DataFrame, labels: DataFrame, k: int | None = None) -> DataFrame:
    """Every document with its importance, perturbed key and whether it is in the sample of ``k``."""
    scored = stored(importances(docs, log_ratios(docs, labels)), "importances")
    n = scored.count()
    if k is None:
        share = labels.where("quality is not null").agg(F.avg((F.col("quality") == 1).cast("double"))).first()[0]
        k = n if share is None else round(n * share)
    if not 0 < k < n:
        return scored.withColumn("selected", F.lit(k >= n))
    border, above = kth_largest(scored, "sample_key", k)
    # rows that tie at the border are taken by id
    tied = scored.where(F.col("sample_key") == border)
    last = tied.orderBy("doc_id").limit(k - above).agg(F.max("doc_id")).first()[0]
    at_border = (F.col("sample_key") == border) & (F.col("doc_id") <= last)
    return scored.withColumn("selected", (F.col("sample_key") > border) | F.coalesce(at_border, F.lit(False)))
