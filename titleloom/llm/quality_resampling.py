"""Quality by importance resampling: hashed n-gram models of target and raw text, sampled by Gumbel top-k.

Words and word pairs are hashed into buckets. One model counts the buckets of target texts, the other those
of all texts. A document's weight is the mean over its n-grams of the logarithm of the ratio of the two,
times ``strength``. Adding Gumbel noise to the weights and taking the largest sums is sampling without
replacement in proportion to the weights. Noise comes from a hash of id and text, so reruns agree.

The mean, not the sum, is the weight: with the sum the longest texts would win or lose whatever they hold.
Target texts are those with a good label, at most ``target_rows`` of them (the lowest hashes of the id), which
bounds what is broadcast. Counts of the raw model cover all texts. The threshold of the sample is found by
histograms of the keys, without sorting.

Defined results
    * Null and empty texts have no n-grams and weight 0. Repeated rows have equal keys.
    * Documents with the key of the threshold are all taken. Labels of unknown ids do nothing; an id with
      several labels is a target if one of them is good.
    * Without target texts all weights are 0 and the sample is uniform. An empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titleloom.llm.common import blob, stored, text_or_empty

BUCKETS = 10_000
TARGET_ROWS = 20_000
#: Share of the documents that are sampled.
SHARE = 0.8
STRENGTH = 20.0
_BINS = 4096

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_TOKEN = re.compile(rb"[0-9a-z\x80-\xff]+|[^\x00-\x200-9a-z\x80-\xff]+")
_PIECE = 1 << 22
_PAIR = np.uint32(0x9E3779B1)


def ngram_counts(text: bytes) -> np.ndarray:
    """Counts of hashed words and word pairs of a UTF-8 text."""
    counts, last = np.zeros(BUCKETS, np.int64), np.zeros(0, np.uint32)
    begin = 0
    while begin < len(text):
        end = text.find(b" ", begin + _PIECE)
        end = len(text) if end < 0 else end
        tokens = _TOKEN.findall(text[begin:end].translate(_LOWER))
        codes = np.fromiter(map(zlib.crc32, tokens), np.uint32, len(tokens))
        counts += np.bincount(codes % BUCKETS, minlength=BUCKETS)
        row = np.concatenate((last, codes))
        pairs = row[:-1] * _PAIR + row[1:]
        counts += np.bincount((pairs ^ (pairs >> np.uint32(15))) % BUCKETS, minlength=BUCKETS)
        last, begin = row[-1:], end
    return counts


def ngram_ratios(docs: DataFrame, targets: DataFrame, id: str, text: str) -> np.ndarray:
    """Logarithm of target over raw probability of each bucket; ``targets`` has distinct ids in ``_target``."""
    rows = docs.select(F.col(id).alias("_id"), text_or_empty(text).alias("_text"))
    marked = rows.join(F.broadcast(targets), rows["_id"] == targets["_target"], "left").select(
        "_text", F.col("_target").isNotNull().alias("good")
    )

    def count(batches):
        total = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            column, good = batch.column("_text"), batch.column("good").to_pylist()
            for i in range(len(batch)):
                found = ngram_counts(blob(column, i))
                total[0] += found
                if good[i]:
                    total[1] += found
        model, bucket = np.nonzero(total)
        columns = [model.astype(np.int32), bucket.astype(np.int32), total[model, bucket]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["model", "bucket", "n"])

    sums = marked.mapInArrow(count, "model int, bucket int, n bigint").groupBy("model", "bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros((2, BUCKETS))
    for row in sums.collect():
        counts[row["model"], row["bucket"]] = row["n"]
    if not counts[1].any():
        return np.zeros(BUCKETS)
    chance = np.log((counts + 1) / (counts.sum(1, keepdims=True) + BUCKETS))
    return chance[1] - chance[0]


def importance_weights(docs: DataFrame, ratios: np.ndarray, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document the id, ``log_weight`` and a ``noise`` that is uniform in (0, 1)."""
    noise = (F.xxhash64(F.lit("gumbel"), F.col(id).cast("string"), F.col(text)).bitwiseAND(F.lit((1 << 52) - 1)) + 0.5)
    rows = docs.select(F.col(id).alias("id"), text_or_empty(text).alias("text"), (noise / float(1 << 52)).alias("noise"))

    def weigh(batches):
        for batch in batches:
            column, means = batch.column("text"), []
            for i in range(len(batch)):
                found = ngram_counts(blob(column, i))
                means.append(float(found @ ratios) / max(1, int(found.sum())))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(means, pa.float64()), batch.column("noise")], ["id", "log_weight", "noise"]
            )

    return rows.mapInArrow(weigh, rows.select("id", F.lit(0.0).alias("log_weight"), "noise").schema)


def kth_largest(rows: DataFrame, key: str, k: int) -> float | None:
    """The ``k``-th largest value of a column, by histograms that narrow down on it."""
    low, high, n = rows.agg(F.min(key), F.max(key), F.count(key)).first()
    if not n or k <= 0:
        return None
    k = min(k, n)
    while low < high:
        width = (high - low) / _BINS
        inside = rows.filter((F.col(key) >= low) & (F.col(key) <= high))
        place = F.least(F.floor((F.col(key) - low) / width), F.lit(_BINS - 1)) if width else F.lit(0)
        bins = inside.groupBy(place.alias("bin")).agg(
            F.count("*").alias("n"), F.min(key).alias("low"), F.max(key).alias("high")
        )
        for one in sorted(bins.collect(), key=lambda r: -r["bin"]):
            if k <= one["n"]:
                low, high = one["low"], one["high"]
                break
            k -= one["n"]
    return low


def resample(
    docs: DataFrame,
    labels: DataFrame,
    share: float = SHARE,
    strength: float = STRENGTH,
    target_rows: int = TARGET_ROWS,
    id: str = "doc_id",
    text: str = "text",
    quality: str = "quality",
) -> DataFrame:
    """Per document the id, ``log_weight``, ``sample_key`` and ``selected``."""
    good = labels.filter(F.col(quality) == 1).select(F.col(id).alias("_target")).filter("_target IS NOT NULL").distinct()
    targets = stored(good.orderBy(F.xxhash64("_target"), "_target").limit(target_rows), "targets")
    ratios = ngram_ratios(docs, targets, id, text)
    gumbel = -F.log(-F.log("noise"))
    keyed = importance_weights(docs, ratios, id, text).select(
        F.col("id").alias(id), "log_weight", (F.col("log_weight") * strength + gumbel).alias("sample_key")
    )
    keyed = stored(keyed, "keys")
    last = kth_largest(keyed, "sample_key", int(np.ceil(share * keyed.count())))
    return keyed.withColumn("selected", F.col("sample_key") >= F.lit(last) if last is not None else F.lit(False))
