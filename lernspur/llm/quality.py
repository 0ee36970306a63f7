"""Quality filter by importance resampling.

Two generative models over hashed n-grams are counted: one of target texts (labelled good), one of
all raw texts. A document's log importance weight is the sum of the log ratios of its n-grams.
Rows are sampled without replacement by Gumbel top-k: the k largest sums of log weight and
Gumbel noise are kept, the noise being a hash of the row, so reruns agree. k is the number of target rows
expected in the raw data: with q the labelled share of good rows, a row with weight w is of the
target with probability min(1, q w), and k is the sum of these.

N-grams are hashed words and pairs of neighbouring word shapes. A shape is the word's case, length class
and last byte, and whether it repeats the word before it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lernspur.runtime import materialize

from .lattice import distinct_words, word_runs
from .text import SLICE, hash_runs, mix, release

BUCKETS = 1 << 14
TARGET_DOCS = 5_000
SMOOTH = 10.0
BINS = 1_024

_UPPER, _LOW, _DIGIT = (np.zeros(256, np.int32) for _ in range(3))
_UPPER[65:91] = _LOW[97:123] = _DIGIT[48:58] = 1


def features(column):
    """Buckets of all n-grams of a text column, with the text of each, a slice of texts at a time."""
    for i, j, data, starts, ends, of in word_runs(column, lower=False, size=SLICE):
        if not len(starts):
            continue
        _, kind, _ = distinct_words(data, starts, ends)
        sizes = ends - starts
        last = data[ends - 1].astype(np.int64)

        def share(table):
            total = np.concatenate(([0], np.cumsum(table[data])))
            return total[ends] - total[starts]

        upper, low, digit = share(_UPPER), share(_LOW), share(_DIGIT)
        case = np.where(upper == 0, 0, np.where(low > 0, 1 + (upper > 1), 3)) + 4 * np.minimum(digit, 2)
        letter = ((last >= 97) & (last <= 122)) | (last >= 128)
        tail = np.where(letter, 1, np.where((last >= 65) & (last <= 90), 2, np.where((last >= 48) & (last <= 57), 3, last)))
        again = np.zeros(len(kind), np.int64)
        again[1:] = (kind[1:] == kind[:-1]) & (of[1:] == of[:-1])
        size = np.minimum(np.floor(np.log2(sizes)), 7).astype(np.int64)
        shape = ((case * 256 + tail) * 8 + size) * 2 + again
        yield i, j, data, starts, ends, of, shape


def _buckets(column):
    """(first text, last + 1, bucket of each n-gram, text of each n-gram)."""
    for i, j, data, starts, ends, of, shape in features(column):
        hashes, at = np.empty(len(starts), np.uint64), 0
        while at < len(starts):
            stop = max(int(np.searchsorted(ends, starts[at] + SLICE, side="right")), at + 1)
            a = int(starts[at])
            b = min(int(ends[stop - 1]), a + SLICE)  # a longer word is known by its beginning
            hashes[at:stop] = hash_runs(data[a:b], starts[at:stop] - a, np.minimum(ends[at:stop], b) - a)
            at = stop
        pair = mix(shape.astype(np.uint64) + np.uint64(1))
        before = np.where(np.concatenate(([True], of[1:] != of[:-1])), np.uint64(0), np.concatenate(([np.uint64(0)], pair[:-1])))
        pairs = mix(pair * np.uint64(3) + before)
        half = np.uint64(BUCKETS // 2)
        yield i, j, np.concatenate((hashes % half, pairs % half + half)).astype(np.int64), np.concatenate((of, of))


def _counts(texts: DataFrame) -> np.ndarray:
    """N-grams per bucket over all rows of ``texts``."""

    def count(batches):
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, _, buckets, _ in _buckets(batch.column(0)):
                total += np.bincount(buckets, minlength=BUCKETS)
        seen = np.flatnonzero(total)
        release()
        yield pa.RecordBatch.from_pydict({"bucket": seen, "n": total[seen]})

    out = np.zeros(BUCKETS)
    # Every task sends each bucket once at most; the driver gets one row per bucket.
    for r in texts.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def learn(documents: DataFrame, labels: DataFrame, target_docs: int = TARGET_DOCS) -> tuple[np.ndarray, float]:
    """(log ratio of each bucket, share of good rows among the labelled).

    The raw model counts every document. The target model counts documents whose labels have
    quality 1, at most ``target_docs`` of them, those with the smallest hash of the id: a bounded
    sample of labelled rows. Null ids, null labels and contradictory ones teach nothing.
    """
    marks = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(
        F.col("doc_id").cast("long").alias("_id")).agg(F.avg("quality").alias("q")).where("q IN (0, 1)")
    share = marks.agg(F.avg("q").alias("q")).first().q
    good = marks.where("q = 1").select("_id").orderBy(F.xxhash64("_id"), "_id").limit(target_docs)
    raw = _counts(documents.select(F.coalesce("text", F.lit("")).alias("text")))
    target = _counts(documents.join(F.broadcast(good), F.col("doc_id") == F.col("_id"), "left_semi")
                     .select(F.coalesce("text", F.lit("")).alias("text")))
    if share is None or target.sum() == 0:
        return np.zeros(BUCKETS), 1.0
    # Both models in the same amount of text, so that smoothing weighs the same in each.
    scaled = raw * (target.sum() / max(raw.sum(), 1.0))
    return np.log((target + SMOOTH) / (scaled + SMOOTH)), float(share)


def weighted(documents: DataFrame, ratios: np.ndarray) -> DataFrame:
    """``documents`` with _features, _log_weight and _key (log weight and Gumbel noise), row by row."""
    names = list(documents.columns)

    def score(batches):
        for batch in batches:
            count, total = np.zeros(batch.num_rows), np.zeros(batch.num_rows)
            for i, j, buckets, of in _buckets(batch.column("text")):
                count[i:j] = np.bincount(of, minlength=j - i)
                total[i:j] = np.bincount(of, weights=ratios[buckets], minlength=j - i)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names], pa.array(count.astype(np.int64)), pa.array(total)],
                names=[*names, "_features", "_log_weight"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema)
    rows = documents.mapInArrow(score, f"{kinds}, _features long, _log_weight double")
    even = (F.shiftrightunsigned(F.xxhash64("doc_id", "text", F.lit("gumbel")), 11).cast("double") + 0.5) / (1 << 53)
    return rows.withColumn("_key", F.col("_log_weight") - F.log(-F.log(even)))


def kth_largest(keys: DataFrame, column: str, k: int) -> float:
    """The k-th largest value of a finite double column; a few passes that each return ``BINS`` rows."""
    value = F.col(column)
    low, high = keys.agg(F.min(value), F.max(value)).first()
    while low < high:
        width = (high - low) / BINS
        if width == 0.0 or low + width == low:
            return low
        bins = (
            keys.where(value.between(low, high))
            .groupBy(F.least(F.floor((value - low) / width), F.lit(BINS - 1)).alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"), F.min(value).alias("a"), F.max(value).alias("b")).collect())
        for r in sorted(bins, key=lambda r: -r.bin):
            if k <= r.n:
                low, high = (r.a, r.a) if k == r.n else (r.a, r.b)
                break
            k -= r.n
    return low


def selection(documents: DataFrame, labels: DataFrame) -> tuple[DataFrame, np.ndarray, float]:
    """(stored weights of all rows, log ratios, least key that is kept)."""
    ratios, share = learn(documents, labels)
    stored = materialize(weighted(documents.select("doc_id", "text"), ratios).drop("text"))
    expected = F.sum(F.exp(F.least(F.lit(0.0), F.col("_log_weight") + float(np.log(max(share, 1e-9))))))
    total = stored.agg(expected.alias("k")).first().k or 0.0
    k = int(round(total))
    return stored, ratios, kth_largest(stored, "_key", k) if k else float("inf")


def quality_scores(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, n_features, log_weight, sample_key, accepted) of every document.

    Null and empty texts have no n-grams and weight 1. Equal rows have equal keys and are kept or
    rejected together. Without usable labels all weights are 1 and all rows are kept.
    """
    stored, _, least = selection(documents, labels)
    return stored.select(
        "doc_id", F.col("_features").alias("n_features"), F.col("_log_weight").alias("log_weight"),
        F.col("_key").alias("sample_key"), (F.col("_key") >= F.lit(least)).alias("accepted"))


def keep_good(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The accepted rows, all columns as they came: weights are computed again rather than joined."""
    _, ratios, least = selection(documents, labels)
    own = documents.select([F.col(f"`{c}`") for c in documents.columns])
    return weighted(own, ratios).where(F.col("_key") >= F.lit(least)).select(
        [F.col(f"`{c}`") for c in documents.columns])
