"""Importance resampling toward a target text: documents whose n-grams look like the target's are drawn more often.

Every text is cut into features, runs of one to `most` words; a feature's bucket is its checksum modulo `buckets`.  The
bucket counts of all documents and of the target texts give one gain a bucket, a document's weight is the sum of its
features' gains, and a seeded Gumbel draw on top of the weight makes the top of the ranking a sample without replacement.

Features are interned block by block in an open-addressed NumPy table: keys are xxhash64 of the feature's bytes, a slot is
shared only after its bytes have been compared, and slots hold bucket and count.  A checksum is then taken once a slot, and
the slot ids of the occurrences gather counts or gains.  A block has at most BLOCK features, so memory does not grow with
texts.  What leaves a task of the counting pass is at most `buckets` sums; the table of gains has `buckets` numbers.

Ranks come from range partitions of narrow rows (ids and numbers) and one offset a partition.

Defined cases: a null, empty or wordless text has no features, weight 0 and is never drawn, unless `least_words` is 0; very
long texts are whole, in blocks; a null doc_id draws with an empty id; ties go to the smaller doc_id (null first), rows
repeated in full get ranks of their own; an empty target or table counts as zeros; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framespan.llm._common import ranked, read_documents, read_table, written
from framespan.llm._vec import LOWER, buffers, chunks

BUCKETS = 10_000
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10
#: features that are interned at a time
BLOCK = 1 << 18

#: bytes inside words: digits, letters and all bytes of other characters
_INSIDE = np.zeros(256, bool)
_INSIDE[0x30:0x3A] = _INSIDE[0x41:0x5B] = _INSIDE[0x61:0x7B] = _INSIDE[0x80:] = True

# fixed values: the five primes of xxhash64
_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
#: shorter features are hashed and compared as 64-bit lanes of whole arrays
SHORT = 32


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return (x << np.uint64(n)) | (x >> np.uint64(64 - n))


def lanes_of(text: np.ndarray, start: np.ndarray, size: np.ndarray) -> list[np.ndarray]:
    """The bytes of features shorter than SHORT as little-endian lanes, zero beyond the end; text has 8 bytes more."""
    found = []
    for k in range(0, int(size.max(initial=0)), 8):
        here = np.flatnonzero(size > k)
        lane = np.zeros(len(start), np.uint64)
        value = np.lib.stride_tricks.sliding_window_view(text, 8)[start[here] + k].copy().view("<u8")[:, 0]
        spare = np.uint64(8) * (np.uint64(8) - np.minimum(size[here] - k, 8).astype(np.uint64))
        lane[here] = (value << spare) >> spare
        found.append(lane)
    return found


def hash_lanes(lanes: list[np.ndarray], size: np.ndarray) -> np.ndarray:
    """xxhash64 with seed 0 of features given as lanes."""
    h = _P5 + size.astype(np.uint64)
    for k, lane in enumerate(lanes):
        left = size - 8 * k
        full = np.flatnonzero(left >= 8)
        h[full] = _turn(h[full] ^ (_turn(lane[full] * _P2, 31) * _P1), 27) * _P1 + _P4
        four = np.flatnonzero((left >= 4) & (left < 8))
        h[four] = _turn(h[four] ^ ((lane[four] & np.uint64(0xFFFFFFFF)) * _P1), 23) * _P2 + _P3
        for b in range(7):  # the bytes after the last four
            one = np.flatnonzero((left < 8) & (left > b) & ((b >= 4) | (left < 4)))
            if len(one):
                h[one] = _turn(h[one] ^ (((lane[one] >> np.uint64(8 * b)) & np.uint64(255)) * _P5), 11) * _P1
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    return h ^ (h >> np.uint64(32))


class Slots:
    """Features text[start:end] interned by open addressing: slot[i] is the slot of occurrence i, first[s] an occurrence
    that holds the bytes of slot s (-1 for free slots), count[s] the number of its occurrences."""

    def __init__(self, text: np.ndarray, start: np.ndarray, end: np.ndarray, key=None):
        size = end - start
        padded = np.concatenate([text, np.zeros(8, np.uint8)])
        short = np.flatnonzero(size < SHORT)
        lanes = [np.zeros(len(start), np.uint64) for _ in range(SHORT // 8)]
        hashes = np.empty(len(start), np.uint64)
        found = lanes_of(padded, start[short], size[short])
        hashes[short] = hash_lanes(found, size[short])
        for k, lane in enumerate(found):
            lanes[k][short] = lane
        for i in np.flatnonzero(size >= SHORT):
            hashes[i] = xxhash.xxh64_intdigest(text[start[i] : end[i]].tobytes())
        if key is not None:
            hashes = key(hashes)
        places = 1 << max(int(2 * len(start) - 1).bit_length(), 3)
        mask = np.uint64(places - 1)
        keys, self.first = np.zeros(places, np.uint64), np.full(places, -1, np.int64)
        self.slot = np.empty(len(start), np.int64)
        self.text, self.start, self.end = text, start, end
        place, todo = (hashes & mask).astype(np.int64), np.arange(len(start))
        while len(todo):
            at = place[todo]
            free = self.first[at] < 0
            self.first[at[free]] = todo[free]  # of several one stays
            keys[at[free]] = hashes[self.first[at[free]]]
            held = self.first[at]
            same = (keys[at] == hashes[todo]) & (size[held] == size[todo])
            for lane in lanes:
                same &= lane[held] == lane[todo]
            for i in np.flatnonzero(same & (size[todo] >= SHORT) & (held != todo)):
                same[i] = self.bytes(todo[i]) == self.bytes(held[i])
            self.slot[todo[same]] = at[same]
            todo = todo[~same]
            place[todo] = (place[todo] + 1) & (places - 1)
        self.count = np.bincount(self.slot, minlength=places)

    def bytes(self, i: int) -> bytes:
        return self.text[self.start[i] : self.end[i]].tobytes()

    def buckets(self, buckets: int) -> np.ndarray:
        """The bucket of every slot in use, taken once; 0 for free ones."""
        found = np.zeros(len(self.first), np.int64)
        for s in np.flatnonzero(self.first >= 0):
            found[s] = zlib.crc32(self.bytes(self.first[s])) % buckets
        return found


def features(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words of documents raw[offsets[d]:offsets[d + 1]], lower-cased and each followed by one space; their first bytes,
    the bytes after the last, and word offsets of each document.  A run of words is then one slice."""
    inside = _INSIDE[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    opens, shuts = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1] | edge[1:-1]
    shuts[:-1] &= ~inside[1:] | edge[1:-1]
    first, last = np.flatnonzero(opens), np.flatnonzero(shuts) + 1
    size = last - first
    start = np.concatenate([[0], np.cumsum(size + 1)])
    text = np.full(start[-1], 0x20, np.uint8)
    text[np.arange(size.sum()) + np.repeat(np.arange(len(size)), size)] = LOWER[raw[inside]]
    return text, start[:-1], start[1:] - 1, np.searchsorted(first, offsets)


def blocks(raw: np.ndarray, offsets: np.ndarray, most: int) -> Iterator[tuple[int, Slots, np.ndarray]]:
    """All features of the documents in blocks of one run length each: the length, their slots and documents."""
    text, start, end, at = features(raw, offsets)
    doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
    for n in range(1, most + 1):
        whole = np.flatnonzero(doc[: len(doc) - n + 1] == doc[n - 1 :]) if len(doc) >= n else np.zeros(0, np.int64)
        for k in range(0, len(whole), BLOCK):
            i = whole[k : k + BLOCK]
            base, stop = start[i[0]], end[i[-1] + n - 1]
            yield n, Slots(text[base:stop], start[i] - base, end[i + n - 1] - base), doc[i]


def bucket_counts(texts: DataFrame, *, buckets: int = BUCKETS, most: int = 1) -> DataFrame:
    """bucket and n, the number of features of all texts in it; every task sends one sum a bucket."""

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in it:
            raw, offsets = buffers(batch.column(0))
            for a, b in chunks(offsets):
                for _, slots, _ in blocks(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], most):
                    used = slots.count > 0
                    np.add.at(total, slots.buckets(buckets)[used], slots.count[used])
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(total[found])], names=["bucket", "n"])

    return texts.select("text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains_of(texts: DataFrame, target: DataFrame, *, buckets: int = BUCKETS, most: int = 1) -> np.ndarray:
    """A thousand times the log ratio of each bucket's smoothed shares in the target and in all texts, rounded down.

    One number a bucket: the table has a fixed size."""
    shares = []
    for table in (texts, target):
        n = np.zeros(buckets, np.int64)
        for row in bucket_counts(table, buckets=buckets, most=most).collect():
            n[row["bucket"]] = row["n"]
        shares.append(n.tolist())
    s, t = shares
    below, above = float(sum(t) + buckets), float(sum(s) + buckets)
    return np.array([math.floor(1000 * math.log((t[b] + 1) * above / ((s[b] + 1) * below))) for b in range(buckets)], np.int64)


def weights(docs: DataFrame, gains: np.ndarray, *, most: int = 1) -> DataFrame:
    """doc_id, n_words, n_features and weight of every document."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            raw, offsets = buffers(batch.column(1))
            rows = [np.zeros(batch.num_rows, np.int64) for _ in range(3)]
            for a, b in chunks(offsets):
                for width, slots, doc in blocks(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], most):
                    gained = gains[slots.buckets(len(gains))][slots.slot]
                    first = np.concatenate([[0], np.flatnonzero(np.diff(doc)) + 1])
                    n = np.diff(np.append(first, len(doc)))
                    if width == 1:
                        rows[0][a + doc[first]] += n
                    rows[1][a + doc[first]] += n
                    rows[2][a + doc[first]] += np.add.reduceat(gained, first)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, rows)], names=["doc_id", "n_words", "n_features", "weight"])

    return docs.select("doc_id", "text").mapInArrow(batches, f"doc_id {kind}, n_words long, n_features long, weight long")


def gumbel(doc_id: Column, seed: int) -> Column:
    """A thousand times a standard Gumbel number that the seed and the id decide, rounded down."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def resample(docs: DataFrame, target: DataFrame, *, percent: int = PERCENT, least_words: int = LEAST_WORDS, buckets: int = BUCKETS, most: int = 1, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every document; the rank is null where it is not drawn.

    Of the documents with at least `least_words` words, `percent` of a hundred are drawn, by score."""
    scored = weights(docs, gains_of(docs, target, buckets=buckets, most=most), most=most)
    scored = written(scored.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed)).withColumn("row", F.monotonically_increasing_id()))
    able = F.col("n_words") >= least_words
    drawn = percent * scored.where(able).count() // 100
    rows = ranked(scored.where(able), F.desc("score"), F.asc("doc_id"), F.asc("row"), name="rank")
    rows = rows.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank"))).unionByName(scored.where(~able).withColumn("rank", F.lit(None).cast("long")))
    return rows.select("doc_id", "n_features", "weight", "score", "rank")


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(read_documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))


#: the checksum is taken byte by byte from its table, once a distinct word
ORACLE_SQL = r"""
WITH tab AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc
), texts AS (
  SELECT 0 AS side, row_number() OVER () AS r, doc_id, text FROM documents UNION ALL SELECT 1, row_number() OVER (), NULL, text FROM benchmark
), found AS (
  SELECT side, r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts
), words AS (
  SELECT side, r, w, count(*) AS n FROM (SELECT side, r, unnest(w) AS w FROM found) GROUP BY ALL
), buckets AS (
  SELECT w, (xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(w)), '..'), lambda p: CAST('0x' || p AS BIGINT))), lambda c, x: xor(c >> 8, crc[xor(c & 255, x) + 1])), 4294967295) % 10000)::INT AS b
  FROM (SELECT DISTINCT w FROM words), tab
), sums AS (
  SELECT b, coalesce(sum(n) FILTER (WHERE side = 0), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (WHERE side = 1), 0)::DOUBLE AS t FROM words JOIN buckets USING (w) GROUP BY b
), gains AS (
  SELECT b, floor(1000 * ln((t + 1) * (sum(s) OVER () + 10000) / ((s + 1) * (sum(t) OVER () + 10000))))::BIGINT AS g FROM sums
), summed AS (
  SELECT r, sum(n * g)::BIGINT AS weight FROM words JOIN buckets USING (w) JOIN gains USING (b) WHERE side = 0 GROUP BY r
), scored AS (
  SELECT doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8) AS BIGINT) + 0.5) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM found LEFT JOIN summed USING (r) WHERE side = 0
), ordered AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS FIRST) AS k, count(*) OVER (PARTITION BY n_features >= 20) AS n FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND k <= 10 * n // 100 THEN k END::BIGINT AS rank FROM ordered
"""
