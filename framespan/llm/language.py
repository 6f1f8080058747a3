"""Language identification as a mixture: a text is words drawn from several languages.

Byte trigrams give a word's likelihood under each language, p(byte | two bytes before), with the word's borders as
bytes.  Expectation-maximisation finds a text's language proportions from the words' likelihoods.  The languages are
then ordered by proportion and the set of the first k is chosen by the penalised likelihood (BIC: log(words)/2 for each
language beyond the first), each set with proportions of its own.  All k are tried, up to all languages, unless even a
mixture that gave every word its best language could not pay the penalty.  The language with the largest share is
predicted.

Trigram counts are summed over all training rows in Spark: vectorised counts of each partition, then one sum by
(language, trigram).  The model keeps the trigrams that were seen, for HELD languages at a time, and what the shorter
contexts give all others: 0.2 MB a language, and 4 bytes for each of its range's trigrams.  It grows with the languages'
spellings and not with the input, and is sent to the tasks.  Scoring is one pass without shuffle; a task has the sums of
HELD languages at a time, and the words of one block or one longer text under all languages.

Defined cases: a null text or one without a letter is `und` with score 0; with no training rows everything is `und`;
ties go to the language first in order; very long texts are whole, one at a time; repeated rows, and rows with one
doc_id, are scored each by itself; an empty table gives no rows; only doc_id, text and (to train) lang are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framespan.llm._common import read_documents, remainder
from framespan.llm._vec import BLANK, buffers, chunks, spans

#: byte classes: 0 blank, 1 digit, 2 other ASCII, 3-28 letters, then bytes from 128 on
CLASSES = 29 + 128
SQUARE = CLASSES**2
CODES = CLASSES**3
#: languages with a dense table at a time, when trigrams are counted and when they are looked up
HELD = 8
UND = "und"
ROUNDS = 12
_CLASS = np.full(256, 2, np.int64)
_CLASS[BLANK] = 0
_CLASS[48:58] = 1
_CLASS[97:123] = np.arange(3, 29)
_CLASS[65:91] = np.arange(3, 29)
_CLASS[128:] = np.arange(29, 157)


def trigrams(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code of the trigram that ends at each byte (bytes before the text's start are blanks), and the classes."""
    c = _CLASS[raw]
    one, two = np.zeros_like(c), np.zeros_like(c)
    one[1:], two[2:] = c[:-1], c[:-2]
    starts = offsets[:-1][np.diff(offsets) > 0]
    one[starts] = 0
    two[starts] = 0
    two[(starts + 1)[starts + 1 < len(c)]] = 0
    two[one == 0] = 0  # a word does not look behind its border
    return (two * CLASSES + one) * CLASSES + c, c


def count_trigrams(docs: DataFrame) -> DataFrame:
    """lang, code and n: trigrams of the whole texts by language."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in it:
            raw, offsets = buffers(batch.column(1))
            langs = batch.column(0).dictionary_encode()
            names, of = langs.dictionary.to_pylist(), langs.indices.to_numpy(zero_copy_only=False)
            for a, b in chunks(offsets):
                part, at = raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                codes, c = trigrams(part, at)
                which = np.repeat(of[a:b], np.diff(at))
                for k in np.unique(of[a:b]):
                    mine, have = codes[which == k], totals.get(names[k])
                    if have is None and len(totals) < HELD:
                        have = totals[names[k]] = np.zeros(CODES, np.int32)
                    if have is None:  # further languages are counted block by block and summed in the grouping
                        yield row(names[k], *np.unique(mine, return_counts=True))
                    else:
                        n = np.bincount(mine, minlength=1)
                        have[: len(n)] += n.astype(np.int32)
            if sum(int(x.max(initial=0)) > 1 << 30 for x in totals.values()):
                yield from rows(totals)
                totals = {}
        yield from rows(totals)

    def rows(totals: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for name, n in totals.items():
            code = np.flatnonzero(n)
            yield row(name, code, n[code])

    def row(name: str, code: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(name, pa.string()), len(code)), pa.array(code.astype(np.int32)), pa.array(n.astype(np.int64))], names=["lang", "code", "n"])

    return docs.select("lang", "text").mapInArrow(batches, "lang string, code int, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))


class Model:
    """log p(byte | two before) of each language, additive smoothing with the shorter context.

    ranges: for HELD languages at a time the codes that one of them has, in order, with a column of logarithms a language;
    a code that none has gets back[its last two bytes] - context[its first two]."""

    def __init__(self, langs: list[str], lang: np.ndarray, code: np.ndarray, n: np.ndarray):
        """lang, code and n: the place in langs, the trigram and its count, each pair once."""
        self.langs: list[str] = langs
        self.ranges: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        order = np.argsort(lang, kind="stable")
        code, n, cuts = code[order], n[order], np.searchsorted(lang[order], np.arange(len(langs) + 1))
        for first in range(0, len(langs), HELD):
            some = range(first, min(first + HELD, len(langs)))
            codes = np.unique(code[cuts[some[0]] : cuts[some[-1] + 1]])
            log = np.empty((len(codes), len(some)), np.float32)
            back, context = np.empty((SQUARE, len(some)), np.float32), np.empty((SQUARE, len(some)), np.float32)
            for column, k in enumerate(some):
                flat = np.zeros(CODES)
                flat[code[cuts[k] : cuts[k + 1]]] = n[cuts[k] : cuts[k + 1]]
                three = flat.reshape(CLASSES, CLASSES, CLASSES)
                two = three.sum(0)
                one = two.sum(0)
                p1 = (one + 0.5) / (one.sum() + 0.5 * CLASSES)
                p2 = ((two + 4 * p1) / (two.sum(-1, keepdims=True) + 4)).ravel()
                total = three.sum(-1).ravel() + 4
                log[:, column] = np.log((flat[codes] + 4 * p2[codes % SQUARE]) / total[codes // CLASSES])
                back[:, column], context[:, column] = np.log(4 * p2), np.log(total)
            self.ranges.append((codes, log, back, context))

    def likelihoods(self, codes: np.ndarray, first: np.ndarray, last: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Log-likelihood of each word, from the byte first to before last, under each language.

        place: CODES numbers -1, used inside and left as they were."""
        like, at = np.empty((len(first), len(self.langs))), 0
        for known, log, back, context in self.ranges:
            place[known] = np.arange(len(known))
            rows = place[codes]
            place[known] = -1
            logs, new = log[rows], np.flatnonzero(rows < 0)
            logs[new] = back[codes[new] % SQUARE] - context[codes[new] // CLASSES]
            sums = np.zeros((len(codes) + 1, log.shape[1]))
            np.cumsum(logs, 0, out=sums[1:])
            like[:, at : at + log.shape[1]] = sums[last] - sums[first]
            at += log.shape[1]
        return like


def train(docs: DataFrame) -> Model:
    """Learns from text and lang of the rows whose lang is not null."""
    found = count_trigrams(docs.where("lang IS NOT NULL")).toArrow()  # the trigrams seen, at most CODES a language
    names = pa.array(found["lang"].to_pylist(), pa.string()).dictionary_encode()
    langs = sorted(names.dictionary.to_pylist())
    place = np.array([langs.index(x) for x in names.dictionary.to_pylist()], np.int64)
    return Model(langs, place[names.indices.to_numpy()], found["code"].to_numpy().astype(np.int64), found["n"].to_numpy())


def mixtures(like: np.ndarray, at: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Proportions by document (rows) and language, 0 outside the chosen set.

    like: log-likelihood of each word under each language; at: word offsets of the documents, none of which is empty."""
    docs, langs = len(at) - 1, like.shape[1]
    sizes = np.diff(at)
    # relative to each word's best language, so that no mixture has a likelihood above 0
    p = np.exp(np.maximum(like - like.max(1, keepdims=True), -60))

    def fit(of_docs: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Proportions and log-likelihoods of some documents, each with its own set of languages."""
        own = sizes[of_docs]
        first = np.cumsum(own) - own
        mine = p[np.arange(own.sum()) + np.repeat(at[of_docs] - first, own)] if len(of_docs) < docs else p
        of = np.repeat(np.arange(len(own)), own)
        share = allowed / allowed.sum(1, keepdims=True)
        for _ in range(rounds):
            r = mine * share[of]
            r /= np.maximum(r.sum(1, keepdims=True), 1e-30)
            share = np.add.reduceat(r, first, 0) / own[:, None]
        return share, np.add.reduceat(np.log(np.maximum((mine * share[of]).sum(1), 1e-30)), first)

    every = np.arange(docs)
    whole, likelihood = fit(every, np.ones((docs, langs)))
    rank = np.argsort(np.argsort(-whole, 1, kind="stable"), 1, kind="stable")
    best, value = np.zeros_like(whole), np.full(docs, -np.inf)
    price = 0.5 * np.log(np.maximum(sizes, 2))
    for k in range(1, langs + 1):
        live = np.flatnonzero(-(k - 1) * price > value + 1e-9)
        if not len(live):
            break
        share, total = fit(live, (rank[live] < k).astype(float)) if k < langs else (whole[live], likelihood[live])
        total = total - (k - 1) * price[live]
        better = total > value[live] + 1e-9
        best[live[better]], value[live[better]] = share[better], total[better]
    return best


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score and the chosen languages with their proportions."""
    if not model.langs:
        return docs.select("doc_id", F.lit(UND).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit("").alias("mixture"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the trigrams of the languages
    block = (1 << 19) * HELD // max(HELD, len(model.langs))

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, place = shared.value, np.full(CODES, -1, np.int32)
        langs = model.langs
        for batch in it:
            raw, offsets = buffers(batch.column(1))
            n = len(batch.column(0))
            pred, score, mixture = [UND] * n, np.zeros(n), [""] * n
            for a, b in chunks(offsets, block):
                part, at = raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                first, last, words_at = spans(part, at)
                if not len(first):
                    continue
                codes, _ = trigrams(part, at)
                like = model.likelihoods(codes, first, last, place)
                some = np.flatnonzero(np.diff(words_at))
                shares = mixtures(like, np.append(words_at[:-1][some], words_at[-1]))
                best = shares.argmax(1)
                for d, k, s in zip(some, best, shares, strict=True):
                    pred[a + d], score[a + d] = langs[k], min(1.0, s[k])
                    mixture[a + d] = " ".join(f"{langs[j]}:{s[j]:.3f}" for j in np.flatnonzero(s > 0))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(pred), pa.array(score), pa.array(mixture)], names=["doc_id", "lang_pred", "score", "mixture"])

    # RLIKE finds a letter of any script
    found = docs.select("doc_id", "text", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("_letters"))
    scored = found.select("doc_id", F.when(F.col("_letters"), F.col("text")).alias("text")).mapInArrow(batches, "doc_id long, lang_pred string, score double, mixture string")
    return scored


def op6_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    model = train(docs.where(remainder("doc_id", 3) != 1))
    return predict(docs, model).select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score", "mixture")
