"""Toxicity by a factorization machine over hashed terms.

A text is the set of its hashed terms: words, lower-cased A-Z without surrounding punctuation, and the first bytes of
longer words. score = sigmoid(b + sum w_i + 1/2 sum_f ((sum v_if)^2 - sum v_if^2)): the
factors v give every pair of terms a weight of its own, so an insult together with a group mention can count more than
both alone.

The model is fitted in numpy on a bounded sample of labelled rows (TRAIN_ROWS, the rows with the smallest hash of
doc_id, which is no input of a score), over terms whose chi-square with the label
reaches LEAST_CHI2: linear weights by FTRL-proximal steps
with an L1 penalty, which leaves most terms at zero; factors only for terms whose linear weight is not zero, by
Adagrad.  Scoring is one pass over all rows without shuffle; what is broadcast are the terms with a weight, fewer than
the terms of the sample.

Defined cases: null and empty texts have no term and score sigmoid(b); without labelled rows of both classes every score
is the share of toxic labels, or 0; repeated words count once; very long texts are worked on alone, as a whole;
repeated rows are scored each by itself; training rows of equal hash come in the order of doc_id and label; only doc_id,
text and toxic are read, and dropping documents keeps all columns, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framespan.llm._common import cut, read_documents, read_table, remainder, text_hash
from framespan.llm._vec import LOWER, buffers, chunks, mix, release, words

BITS = 22
FACTORS = 8
TRAIN_ROWS = 12_000
#: chi-square that a term needs, with one degree of freedom
LEAST_CHI2 = 15.0
#: bytes of the prefix of a longer word that is a term of its own
PREFIX = 4
_EDGE = np.zeros(256, bool)
_EDGE[[ord(c) for c in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"]] = True


def terms(raw: np.ndarray, offsets: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed terms of each document, and their offsets.

    Punctuation bytes become blanks, so that `scum,` and `"scum"` are the same term."""
    clean = np.where(_EDGE[raw], np.uint8(32), raw)
    w = words(clean, offsets)
    doc = w.doc
    long = np.flatnonzero(w.end - w.start > PREFIX)
    letters = LOWER[clean[w.start[long][:, None] + np.arange(PREFIX)]].astype(np.uint64)
    prefix = mix((letters << (np.arange(PREFIX, dtype=np.uint64) * np.uint64(8))).sum(1, dtype=np.uint64) + np.uint64(0xABCDEF01))
    value = np.concatenate([w.hash, prefix]) >> np.uint64(64 - bits)
    key = np.unique((np.concatenate([doc, doc[long]]).astype(np.uint64) << np.uint64(bits)) | value)
    of = (key >> np.uint64(bits)).astype(np.int64)
    return (key & np.uint64((1 << bits) - 1)).astype(np.int64), np.searchsorted(of, np.arange(len(offsets)))


def term_arrays(docs: DataFrame, *keep: str) -> DataFrame:
    """The kept columns and the hashed terms of each text."""
    names = [*keep, "text"]

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in it:
            raw, offsets = buffers(batch.column(len(keep)))
            for a, b in chunks(offsets):
                found, at = terms(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(found.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*[batch.column(i).slice(a, b - a) for i in range(len(keep))], lists], names=[*keep, "terms"])

    schema = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*names).mapInArrow(batches, f"{schema}, terms array<int>")


class FactorizationMachine:
    """Terms in order (hashes), their linear weights and factors; other terms have none."""

    def __init__(self, known: np.ndarray, factors: int = FACTORS, seed: int = 11):
        self.known, self.bias, self.seed = known, 0.0, seed
        self.w, self.v = np.zeros(len(known)), np.zeros((len(known), factors), np.float32)

    def places(self, x: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the known terms among x, and the documents' offsets among them."""
        if not len(self.known):
            return np.zeros(0, np.int64), np.zeros(len(at), np.int64)
        place = np.minimum(np.searchsorted(self.known, x), len(self.known) - 1)
        kept = np.flatnonzero(self.known[place] == x)
        return place[kept], np.searchsorted(kept, at)

    def pruned(self) -> FactorizationMachine:
        live = self.w != 0
        small = FactorizationMachine(self.known[live], self.v.shape[1], self.seed)
        small.bias, small.w, small.v = self.bias, self.w[live], self.v[live]
        return small

    def margin(self, x: np.ndarray, at: np.ndarray) -> np.ndarray:
        """b + linear part + pairs, of the documents whose places are x[at[d]:at[d + 1]]."""
        sums = np.concatenate([[0.0], np.cumsum(self.w[x])])
        rows = self.v[x].astype(np.float64)
        first = np.concatenate([np.zeros((1, rows.shape[1])), np.cumsum(rows, 0)])
        second = np.concatenate([[0.0], np.cumsum((rows**2).sum(1))])
        total = first[at[1:]] - first[at[:-1]]
        return self.bias + sums[at[1:]] - sums[at[:-1]] + 0.5 * ((total**2).sum(1) - (second[at[1:]] - second[at[:-1]]))

    def score(self, x: np.ndarray, at: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x, at), -30, 30)))

    def fit(self, x: np.ndarray, at: np.ndarray, y: np.ndarray, *, epochs: int = 12, batch: int = 64, l1: float = 2.0, l2: float = 1.0, rate: float = 0.5, factor_rate: float = 0.02, factor_l2: float = 0.05) -> FactorizationMachine:
        rng = np.random.default_rng(self.seed)
        z, n = np.zeros_like(self.w), np.zeros_like(self.w)
        g2 = np.full(self.v.shape, 1e-2, np.float32)
        base = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
        self.bias, bias_g2 = float(np.log(base / (1 - base))), 1.0
        sizes = np.diff(at)
        for epoch in range(epochs):
            for rows in np.array_split(rng.permutation(len(y)), max(1, len(y) // batch)):
                own = sizes[rows]
                to = np.concatenate([[0], np.cumsum(own)])
                idx = x[np.arange(to[-1]) + np.repeat(at[rows] - to[:-1], own)]
                miss = self.score(idx, to) - y[rows]
                each = np.repeat(miss, own)
                used, inverse = np.unique(idx, return_inverse=True)
                g = np.bincount(inverse, each, len(used))
                grown = n[used] + g * g
                z[used] += g - (np.sqrt(grown) - np.sqrt(n[used])) / rate * self.w[used]
                n[used] = grown
                zu = z[used]
                self.w[used] = np.where(np.abs(zu) <= l1, 0.0, -(zu - np.sign(zu) * l1) / ((1 + np.sqrt(grown)) / rate + l2))
                bias_g2 += float(miss.sum()) ** 2
                self.bias -= rate * float(miss.sum()) / np.sqrt(bias_g2)
                if epoch >= 1:
                    self._pairs(idx, to, miss, used[self.w[used] != 0], g2, rng, factor_rate, factor_l2)
        return self

    def _pairs(self, idx, to, miss, live, g2, rng, rate, l2) -> None:
        """One Adagrad step on the factors of the terms whose linear weight is not zero."""
        new = live[self.v[live, 0] == 0]
        self.v[new] = rng.normal(0, 0.02, (len(new), self.v.shape[1]))
        at = np.flatnonzero(self.v[idx, 0] != 0)
        if not len(at):
            return
        doc = np.searchsorted(to, at, "right") - 1
        rows = self.v[idx[at]]
        edges = np.searchsorted(doc, np.arange(len(to)))
        first = np.concatenate([np.zeros((1, rows.shape[1])), np.cumsum(rows, 0)])
        total = (first[edges[1:]] - first[edges[:-1]])[doc]
        used, inverse = np.unique(idx[at], return_inverse=True)
        g = np.zeros((len(used), rows.shape[1]))
        np.add.at(g, inverse, miss[doc][:, None] * (total - rows))
        g += l2 * self.v[used]
        g2[used] += g**2
        self.v[used] -= rate * g / np.sqrt(g2[used])


def screened(x: np.ndarray, at: np.ndarray, y: np.ndarray, least: float = LEAST_CHI2) -> np.ndarray:
    """Terms whose presence depends on the label."""
    known, inverse = np.unique(x, return_inverse=True)
    n = np.bincount(inverse, minlength=len(known)).astype(float)
    hit = np.bincount(inverse, np.repeat(y, np.diff(at)), len(known))
    total, rate = len(y), y.mean()
    spread = n * rate * (1 - rate) * (1 - n / total)
    return known[(hit - n * rate) ** 2 >= least * np.maximum(spread, 1e-9)]


def train_on(sample: DataFrame, label: str, order: tuple[str, ...] = ()) -> FactorizationMachine:
    """Fits a machine on terms and label of a sample; sorted by the columns `order`, so that a run repeats another."""
    found = sample.toArrow()  # bounded by the sample
    if order:
        found = found.sort_by([(c, "ascending") for c in order])
    lists = found["terms"].combine_chunks()
    y = found[label].to_numpy().astype(float)
    if not len(y) or y.min() == y.max():
        machine = FactorizationMachine(np.zeros(0, np.int64))
        machine.bias = 30.0 if len(y) and y[0] else -30.0
        return machine
    x, at = lists.values.to_numpy().astype(np.int64), lists.offsets.to_numpy().astype(np.int64)
    machine = FactorizationMachine(screened(x, at, y))
    return machine.fit(*machine.places(x, at), y).pruned()


def batch_scores(model: FactorizationMachine, texts: pa.Array) -> np.ndarray:
    """Scores of a column of texts, in blocks of bounded size."""
    raw, offsets = buffers(texts)
    found = [np.zeros(0)]
    for a, b in chunks(offsets):
        found.append(model.score(*model.places(*terms(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]))))
    return np.concatenate(found)


def score(docs: DataFrame, machine: FactorizationMachine) -> DataFrame:
    """doc_id and score of every text."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # bounded by the sample's terms

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in it:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(batch_scores(shared.value, batch.column(1)))], names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(batches, "doc_id long, score double")


def without_toxic(docs: DataFrame, machine: FactorizationMachine, bound: float = 0.5) -> DataFrame:
    """The rows, with all columns, whose score is below the bound.  Every row is judged by its own text; no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    at = docs.columns.index("text")

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in it:
            yield batch.filter(pa.array(batch_scores(shared.value, batch.column(at)) < bound))

    return docs.mapInArrow(batches, docs.schema)


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text, toxic and the hash of the text of labelled documents outside the held-out fold; TRAIN_ROWS at most.

    Labels are chosen first and then, of the texts under their ids, as many again, both by hash and from ids and hashes
    alone.  Texts stay in the tasks that read them; only where rows are repeated with doc_id and text they are moved, one
    a task, to leave one of them."""
    wanted = labels.where(F.col("toxic").isNotNull() & (remainder("doc_id", 5) != 0)).select("doc_id", "toxic")
    # the sample is taken before texts are joined: ids alone are sorted
    chosen = wanted.distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(TRAIN_ROWS)
    order = [F.xxhash64("doc_id"), "doc_id", "toxic", "th"]
    named = docs.select("doc_id", text_hash().alias("th")).join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "th", "toxic").agg(F.count(F.lit(1)).alias("c"))
    named = cut(named.orderBy(*order).limit(TRAIN_ROWS))
    rows = docs.select("doc_id", "text", text_hash().alias("th")).join(F.broadcast(named.drop("c")), ["doc_id", "th"])  # bounded by TRAIN_ROWS
    return rows.dropDuplicates(["doc_id", "th", "toxic"]) if named.where("c > 1").limit(1).count() else rows


def fit_from_tables(docs: DataFrame, labels: DataFrame) -> FactorizationMachine:
    rows = training_rows(docs, labels).withColumn("place", F.xxhash64("doc_id"))
    return train_on(term_arrays(rows, "place", "doc_id", "toxic", "th"), "toxic", order=("place", "doc_id", "toxic", "th"))


def op3_toxicity_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    machine = fit_from_tables(docs, read_table(spark, sf_dir, "labels"))
    return score(docs, machine).select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
