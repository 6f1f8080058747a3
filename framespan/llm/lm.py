"""Language-model scores: a log-bilinear neural model with classes, trained by noise-contrastive estimation.

Tokens are words, lower-cased A-Z, and one end a text.  Own words are the training words with LEAST_COUNT occurrences or
more, OWN at most, the most frequent first.  The model first chooses a unit: one of the SINGLES most frequent words, the
end, or one of the units of CLASSES classes that hold the other words by their last two bytes (a class of many own words is
several units of INNER words at most); then, inside the unit, one of its own words or the class's "rest", by vectors of
their own; then a word of the rest by its count:
p(w) = p(unit | context) p(rest | unit, context) (c + 0.1) / (N_rest + 0.1 (V_rest + 1)).  The probabilities of all
words and of one unseen word a class add to one.

A choice is linear in the context's vector: (r1[word before] + mean of r2[the WINDOW words before that]) . q[choice] +
b[choice]; words that are not own ones have their class's vectors.  Normalisation is exact: a batched matrix product gives
the scores of all units for a block of tokens, and one product a class those of its words.

Counts of all words are summed by Spark from vectorised counts of each partition.  Training: a start from a bounded sample
of texts on the driver, then one pass over all training texts in which every partition takes noise-contrastive steps
from that start, and the average of the partitions' parameters, each weighted by how often the partition used it.  Rows
are dealt to partitions by Spark's reader: the same files and settings give the same model, others one that differs as
training runs do.

Scoring is one pass.  The FREQUENT most frequent words are resolved in it from a table of fixed size; what is left,
pairs of a text and a rarer word, is joined with the counts by word and summed by text.  Words are told apart by 64-bit
hashes.

Defined cases: null and empty texts are one end; without training rows N and V are 0 and all words are unseen; very long
texts are worked on alone, as a whole; repeated rows, and rows with one doc_id, are scored each by itself; words of equal
count come in the order of their hash; an empty table gives no rows; only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framespan.llm._common import read_documents, remainder, written
from framespan.llm._vec import LOWER, buffers, chunks, mix, words

#: own words with vectors: most of them (with classes under 2**16), and the occurrences that one needs
OWN, LEAST_COUNT = 1 << 14, 10
SINGLES, CLASSES, FREQUENT = 63, 128, 1 << 17
#: most inner choices of a unit: larger classes are several units, the first with the rest
INNER = 96
END = SINGLES  # the unit of the end; classes come after it
SIZE, WINDOW = 16, 16  # WINDOW is a power of two
#: noise units that a batch shares, noise words of each token in a class, tokens of a batch and of a block
NOISE, INNER_NOISE, BATCH, BLOCK = 16, 1, 4096, 1 << 15
#: tokens whose scores are held at a time
SCORED = 2048
#: bits of a hash that the directory of frequent words is read by
FIRST_BITS = 18
SHIFT = np.uint64(64 - FIRST_BITS)
#: tokens of the start on the driver
START_TOKENS, START_ROUNDS = 300_000, 8
SMOOTH = 0.1


def class_of(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Class of each word, from its last two bytes."""
    last = LOWER[raw[end - 1]].astype(np.uint64)
    other = np.where(end - start > 1, LOWER[raw[np.maximum(end - 2, 0)]], 0).astype(np.uint64)
    return (mix(last * np.uint64(256) + other + np.uint64(1)) % np.uint64(CLASSES)).astype(np.int64)


def count_words(docs: DataFrame, train: Column) -> DataFrame:
    """h, class, n_train and n_all of every word."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size = 0
        for batch in it:
            raw, offsets = buffers(batch.column(1))
            mine = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for a, b in chunks(offsets):
                part = raw[offsets[a] : offsets[b]]
                w = words(part, offsets[a : b + 1] - offsets[a])
                if len(w.hash):
                    h, first, inverse = np.unique(w.hash, return_index=True, return_inverse=True)
                    own = np.repeat(mine[a:b], np.diff(w.at))
                    held.append((h, class_of(part, w.start[first], w.end[first]), np.bincount(inverse, own, len(h)).astype(np.int64), np.bincount(inverse, minlength=len(h))))
                    size += len(h)
            if size > 4_000_000:
                yield merged(held)
                held, size = [], 0
        if held:
            yield merged(held)

    def merged(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        h, kind, train_n, all_n = (np.concatenate(x) for x in zip(*held, strict=True))
        h, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(kind[first].astype(np.int32)), pa.array(np.bincount(inverse, train_n, len(h)).astype(np.int64)), pa.array(np.bincount(inverse, all_n, len(h)).astype(np.int64))], names=["h", "class", "n_train", "n_all"])

    counted = docs.select(train.cast("int").alias("t"), "text").mapInArrow(batches, "h long, class int, n_train long, n_all long")
    return counted.groupBy("h", "class").agg(F.sum("n_train").alias("n_train"), F.sum("n_all").alias("n_all"))


@dataclass
class Vocabulary:
    """Frequent words in order of hash: training count, place among the own words or -1, class; and totals.

    Own words are numbered: singles first, then class by class; `slots` is the first slot of each unit after END among the
    inner choices; rest_unit and rest_slot say where a class's other words are, rest_class whose rest a slot is, or -1."""

    hashes: np.ndarray
    counts: np.ndarray
    own: np.ndarray
    tokens: int
    distinct: int
    texts: int
    rest_tokens: np.ndarray
    rest_distinct: np.ndarray
    unit_counts: np.ndarray
    slots: np.ndarray
    slot_of: np.ndarray
    slot_counts: np.ndarray
    unit_of: np.ndarray
    rest_unit: np.ndarray
    rest_slot: np.ndarray
    rest_class: np.ndarray
    #: the hashes, and where those start that have the same first bits
    first: tuple[np.ndarray, np.ndarray] | None = field(default=None, init=False, repr=False, compare=False)

    @property
    def base_total(self) -> float:
        return self.tokens + SMOOTH * (self.distinct + 1)

    @property
    def contexts(self) -> int:
        """Own words, the end, and the classes of all others."""
        return len(self.unit_of) + 1 + CLASSES

    def rest_total(self) -> np.ndarray:
        return self.rest_tokens + SMOOTH * (self.rest_distinct + 1)

    def place(self, h: np.ndarray) -> np.ndarray:
        """Place of each word among the frequent ones, or -1."""
        if not len(self.hashes):
            return np.full(len(h), -1)
        if self.first is None or self.first[0] is not self.hashes:
            self.first = self.hashes, np.searchsorted(self.hashes, np.arange(1 << FIRST_BITS, dtype=np.uint64) << SHIFT)
        # hashes are spread evenly: few have the same first bits, so few words are still smaller after a step or two
        last = len(self.hashes) - 1
        at = np.minimum(self.first[1].take((h >> SHIFT).view(np.int64)), last)
        found = self.hashes.take(at)
        more = np.flatnonzero(found < h)
        while len(more):
            at[more] += 1
            more = more[at[more] <= last]
            found[more] = self.hashes.take(at[more])
            more = more[found[more] < h[more]]
        return np.where(found == h, at, -1)


def most_frequent(counts: DataFrame) -> DataFrame:
    """Words whose count reaches a bound, the lowest of the sixteenths of octaves that leaves FREQUENT at most.

    The bound comes from a table of some hundred rows, so no task sorts or gathers what all others found."""
    step = F.floor(F.log2(F.col("n_all").cast("double")) * 16).cast("int")
    sizes = sorted(((r["step"], r["count"]) for r in counts.groupBy(step.alias("step")).count().collect()), reverse=True)
    bound, total = 1 << 30, 0
    for at, size in sizes:
        total += size
        if total > FREQUENT:
            break
        bound = at
    return counts.where(step >= bound)


def vocabulary(counts: DataFrame, texts: int) -> Vocabulary:
    """From the count table; what reaches the driver are FREQUENT rows and one row a class."""
    top = most_frequent(counts).toArrow()
    h, kind, n = top["h"].to_numpy().view(np.uint64), top["class"].to_numpy().astype(np.int64), top["n_train"].to_numpy()
    order = np.lexsort((h, -n))
    order = order[n[order] >= LEAST_COUNT][:OWN]
    singles, others = order[:SINGLES], order[SINGLES:]
    others = others[np.argsort(kind[others], kind="stable")]
    sums = counts.where("n_train > 0").groupBy("class").agg(F.sum("n_train").alias("n"), F.count(F.lit(1)).alias("v")).toArrow()
    rest_tokens, rest_distinct = np.zeros(CLASSES), np.zeros(CLASSES)
    rest_tokens[sums["class"].to_numpy()], rest_distinct[sums["class"].to_numpy()] = sums["n"].to_numpy(), sums["v"].to_numpy()
    tokens, distinct = int(rest_tokens.sum()) + texts, int(rest_distinct.sum()) + (texts > 0)
    np.subtract.at(rest_tokens, kind[order], n[order])
    np.subtract.at(rest_distinct, kind[order], 1)
    # units of each class: the first has its rest as the last inner choice
    members = np.bincount(kind[others], minlength=CLASSES)
    first = np.cumsum(members) - members
    place = np.arange(len(others)) - first[kind[others]]
    part = (place + 1) // INNER
    parts = members // INNER + 1
    rest_unit = END + 1 + np.cumsum(parts) - parts
    unit_of = np.concatenate([np.arange(len(singles)), rest_unit[kind[others]] + part])
    slot_of = np.concatenate([np.full(len(singles), -1), np.arange(len(others)) + kind[others] + (part > 0)])
    rest_slot = first + np.arange(CLASSES) + np.minimum(members, INNER - 1)
    sizes = np.bincount(np.concatenate([unit_of[len(singles) :], rest_unit]) - END - 1, minlength=parts.sum())
    slots = np.concatenate([[0], np.cumsum(sizes)])
    slot_counts, rest_class = np.zeros(slots[-1]), np.full(slots[-1], -1)
    slot_counts[slot_of[len(singles) :]], slot_counts[rest_slot] = n[others], rest_tokens
    rest_class[rest_slot] = np.arange(CLASSES)
    unit_counts = np.zeros(END + 1 + len(sizes))
    unit_counts[: len(singles)], unit_counts[END] = n[singles], texts
    unit_counts[END + 1 :] = np.add.reduceat(slot_counts, slots[:-1])
    number = np.full(len(h), -1)
    number[np.concatenate([singles, others])] = np.arange(len(order))
    by_hash = np.argsort(h)
    return Vocabulary(h[by_hash], n[by_hash], number[by_hash], tokens, distinct, texts, rest_tokens, rest_distinct, unit_counts, slots, slot_of, slot_counts, unit_of, rest_unit, rest_slot, rest_class)


@dataclass
class Tokens:
    """Tokens of some texts, ends included: unit, inner slot (-1: none), context number of each, the token before it and
    how many tokens of the text come before; first: the texts' first tokens; place: among frequent words (-2: an end)."""

    unit: np.ndarray
    slot: np.ndarray
    context: np.ndarray
    before: np.ndarray
    depth: np.ndarray
    first: np.ndarray
    place: np.ndarray


def tokens_of(raw: np.ndarray, offsets: np.ndarray, voc: Vocabulary):
    """Tokens of the documents, and their words."""
    w = words(raw, offsets)
    at = voc.place(w.hash)
    number = voc.own[at] if len(voc.own) else np.full(len(at), -1)
    number = np.where(at >= 0, number, -1)
    kind = class_of(raw, w.start, w.end)
    own = number >= 0
    unit, slot = voc.rest_unit[kind], voc.rest_slot[kind]
    unit[own], slot[own] = voc.unit_of[number[own]], voc.slot_of[number[own]]
    n_own = len(voc.unit_of)
    docs = len(offsets) - 1
    flat = np.arange(len(unit)) + w.doc
    total = len(unit) + docs
    out = [np.full(total, x) for x in (END, -1, n_own, -2)]
    for target, values in zip(out, (unit, slot, np.where(own, number, n_own + 1 + kind), at), strict=True):
        target[flat] = values
    first = w.at[:-1] + np.arange(docs)
    depth = np.arange(total) - np.repeat(first, np.diff(np.append(first, total)))
    before = np.full(total, n_own)
    before[1:] = out[2][:-1]
    before[first] = n_own
    return Tokens(out[0], out[1], out[2], before, depth, first, out[3]), w


def _sums(index: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The indices in order and the sum of the rows of each."""
    # contexts, units and slots fit in 16 bits, which are sorted by radix
    order = np.argsort(index.astype(np.uint16), kind="stable")
    at = index.take(order)
    if not len(at):
        return at, rows[:0]
    starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    sizes = np.diff(np.append(starts, len(at)))
    sums = rows.take(order.take(starts), 0)
    # most have one row or two, which reduceat would take one by one
    pairs = np.flatnonzero(sizes == 2)
    sums[pairs] += rows.take(order.take(starts.take(pairs) + 1), 0)
    many = np.flatnonzero(sizes > 2)
    if len(many):
        inside = np.repeat(sizes > 2, sizes)
        lengths = sizes.take(many)
        sums[many] = np.add.reduceat(rows.take(order[inside], 0), np.cumsum(lengths) - lengths, 0)
    return at.take(starts), sums


def window_sums(rows: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """For each row the sum of the WINDOW rows of its text that end with it, or of all there are: sums of 2 rows, of 4 and
    so on.  depth: how many rows of the text come before it."""
    width = 1
    while width < WINDOW:
        wider = np.empty_like(rows)
        np.add(rows[width:], rows[:-width], out=wider[width:])
        edge = np.flatnonzero(depth < width)
        wider[edge] = rows.take(edge, 0)
        rows, width = wider, 2 * width
    return rows


class LogBilinear:
    """r1, r2: vectors of contexts; q, b: of units; q2, b2: of the inner slots."""

    PARTS = ("r1", "r2", "q", "q2")

    def __init__(self, voc: Vocabulary, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.voc = voc
        noise = voc.unit_counts + 1.0
        self.noise = noise / noise.sum()
        inner = voc.slot_counts + 1.0
        self.inner_edges = np.concatenate([[0.0], np.cumsum(inner)])
        per_class = np.add.reduceat(inner, voc.slots[:-1])
        self.inner = inner / np.repeat(per_class, np.diff(voc.slots))
        # the last column of q and q2 is the bias
        sizes = {"r1": (voc.contexts, SIZE), "r2": (voc.contexts, SIZE), "q": (len(noise), SIZE + 1), "q2": (len(inner), SIZE + 1)}
        for name, shape in sizes.items():
            setattr(self, name, rng.normal(0, 0.1, shape).astype(np.float32))
        self.q[:, SIZE], self.q2[:, SIZE] = np.log(self.noise), np.log(self.inner)
        self.g = {name: np.full(shape, 0.1, np.float32) for name, shape in sizes.items()}
        self.used = {name: np.zeros(shape[0], np.int64) for name, shape in sizes.items()}

    def _learn(self, name: str, index: np.ndarray, rows: np.ndarray, scale: float, rate: float) -> None:
        """One Adagrad step on the rows of a table."""
        at, grad = _sums(index, rows)
        grad = grad / scale
        seen = self.g[name].take(at, 0) + grad * grad
        self.g[name][at] = seen
        table = getattr(self, name)
        grad *= rate
        grad /= np.sqrt(seen, out=seen)
        table[at] = table.take(at, 0) - grad
        self.used[name][at] += 1

    def far(self, t: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """For each token the mean of r2 over the WINDOW tokens before the last one, then a one for the bias; and one part
        of that mean (0: no such token)."""
        part = np.where(t.depth > 1, 1 / np.clip(t.depth - 1, 1, WINDOW), 0).astype(np.float32)
        far = np.zeros((len(part), SIZE + 1), np.float32)
        np.multiply(window_sums(self.r2.take(t.context, 0), t.depth)[:-2], part[2:, None], out=far[2:, :SIZE])
        far[:, SIZE] = 1
        return far, part

    def fit(self, t: Tokens, rng: np.random.Generator, rate: float) -> None:
        """Noise-contrastive steps over the tokens in random order, in batches; r2 follows at the end."""
        far, part = self.far(t)
        pull = np.zeros((len(far), SIZE), np.float32)
        edges = np.cumsum(self.noise)
        log_kn, log_inner = np.log(NOISE * self.noise).astype(np.float32), np.log(INNER_NOISE * self.inner).astype(np.float32)
        order = rng.permutation(len(t.unit))
        for a in range(0, len(order), BATCH):
            pick = order[a : a + BATCH]
            unit, slot, before = t.unit.take(pick), t.slot.take(pick), t.before.take(pick)
            h1 = far.take(pick, 0)
            h1[:, :SIZE] += self.r1.take(before, 0)
            drawn = np.searchsorted(edges, rng.random(NOISE)).clip(max=len(edges) - 1)
            q_unit, q_drawn = self.q.take(unit, 0), self.q[drawn]
            miss = _sigmoid(np.einsum("ij,ij->i", h1, q_unit) - log_kn.take(unit)) - 1
            wrong = _sigmoid(h1 @ q_drawn.T - log_kn[drawn])
            dh = wrong @ q_drawn[:, :SIZE]
            q_unit *= miss[:, None]
            dh += q_unit[:, :SIZE]
            inside = np.flatnonzero(slot >= 0)
            if len(inside):
                h_inside = h1.take(inside, 0)
                group = unit.take(inside) - END - 1
                first, stop = self.voc.slots.take(group), self.voc.slots.take(group + 1)
                lo, hi = self.inner_edges.take(first), self.inner_edges.take(stop)
                index = [slot.take(inside)]
                q_slot = self.q2.take(index[0], 0)
                m = _sigmoid(np.einsum("ij,ij->i", h_inside, q_slot) - log_inner.take(index[0])) - 1
                q_slot *= m[:, None]
                grads = [m[:, None] * h_inside]
                for _ in range(INNER_NOISE):
                    other = np.searchsorted(self.inner_edges, lo + (hi - lo) * rng.random(len(inside)), "right") - 1
                    other = np.clip(other, first, stop - 1)
                    q_other = self.q2.take(other, 0)
                    m = _sigmoid(np.einsum("ij,ij->i", h_inside, q_other) - log_inner.take(other))
                    q_other *= m[:, None]
                    q_slot += q_other
                    index.append(other)
                    grads.append(m[:, None] * h_inside)
                dh[inside] += q_slot[:, :SIZE]
                self._learn("q2", np.concatenate(index), np.concatenate(grads), 8.0, rate)
            scale = float(np.sqrt(len(pick)))
            wrong = wrong.T @ h1
            h1 *= miss[:, None]
            self._learn("q", np.concatenate([unit, drawn]), np.concatenate([h1, wrong]), scale, rate)
            self._learn("r1", before, dh, 8.0, rate)
            pull[pick] = dh
        # a token's r2 is in the means of the WINDOW tokens of its text from the second after it on
        pull *= part[:, None]
        left = np.repeat(np.append(t.first[1:], len(pull)), np.diff(np.append(t.first, len(pull)))) - np.arange(len(pull)) - 1
        sums = np.zeros_like(pull)
        sums[:-2] = window_sums(pull[::-1], left[::-1])[::-1][2:]
        sums[left < 2] = 0
        self._learn("r2", t.context, sums, 8.0, rate)

    def log_probabilities(self, t: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """Natural log-probabilities of the tokens' units, and of their slots inside the classes (0 without)."""
        h, _ = self.far(t)
        h[:, :SIZE] += self.r1.take(t.before, 0)
        units, inner = np.zeros(len(t.unit)), np.zeros(len(t.unit))
        held = np.empty(SCORED * max(len(self.q), int(np.diff(self.voc.slots).max())), np.float32)
        for a in range(0, len(h), SCORED):
            units[a : a + SCORED] = _log_softmax(h[a : a + SCORED], self.q, t.unit[a : a + SCORED], held)
        inside = np.flatnonzero(t.slot >= 0)
        inside = inside[np.argsort(t.unit[inside], kind="stable")]
        cuts = np.flatnonzero(np.diff(t.unit[inside])) + 1
        for rows in np.split(inside, cuts) if len(inside) else []:
            unit = t.unit[rows[0]] - END - 1
            lo, hi = self.voc.slots[unit], self.voc.slots[unit + 1]
            for k in range(0, len(rows), SCORED) if hi - lo > 1 else ():
                some = rows[k : k + SCORED]
                inner[some] = _log_softmax(h.take(some, 0), self.q2[lo:hi], t.slot.take(some) - lo, held)
        return units, inner


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _log_softmax(h: np.ndarray, table: np.ndarray, chosen: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Log of the softmax of h . table's rows at one row for each h; held: room for all scores."""
    scores = held[: len(h) * len(table)].reshape(len(h), len(table))
    np.matmul(h, table.T, out=scores)
    own = scores[np.arange(len(scores)), chosen]
    top = scores.max(1, keepdims=True) if scores.max() > 60 else None
    if top is not None:
        scores -= top
        own = own - top[:, 0]
    np.exp(scores, out=scores)
    return own - np.log(scores @ np.ones(len(table), np.float32))


def blocks_of_tokens(raw: np.ndarray, offsets: np.ndarray, voc: Vocabulary) -> Iterator[Tokens]:
    """Tokens of some texts at a time, about BLOCK."""
    for a, b in chunks(offsets, 6 * BLOCK):
        yield tokens_of(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], voc)[0]


def start_model(training: DataFrame, voc: Vocabulary) -> LogBilinear:
    """A model from a bounded sample of training texts: whole texts up to START_TOKENS tokens."""
    model, rng = LogBilinear(voc), np.random.default_rng(5)
    share = min(1.0, START_TOKENS / max(voc.tokens, 1))
    sample = training.sample(share, 9) if share < 1 else training
    size = F.octet_length("text").cast("long")
    raw, offsets = buffers(sample.where(size <= 8 * START_TOKENS).select("text").limit(START_TOKENS // 20).toArrow()["text"].combine_chunks())
    last = int(np.searchsorted(offsets, 16 * START_TOKENS, "right")) - 1
    for k in range(START_ROUNDS if last > 0 else 0):
        for t in blocks_of_tokens(raw[: offsets[last]], offsets[: last + 1], voc):
            model.fit(t, rng, 0.4 / (1 + k / 2))
    return model


def trained(training: DataFrame, voc: Vocabulary) -> LogBilinear:
    """One pass over all training texts from the start, averaged over partitions by use."""
    start = start_model(training, voc)
    shared = training.sparkSession.sparkContext.broadcast((voc, {n: getattr(start, n) for n in start.PARTS}, start.g))  # bounded by OWN

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc, values, seen = shared.value
        model = LogBilinear(voc)
        for n in model.PARTS:
            setattr(model, n, values[n].copy())
            model.g[n] = 4 * seen[n]
        rng = np.random.default_rng(1)
        for batch in it:
            for t in blocks_of_tokens(*buffers(batch.column(0)), voc):
                model.fit(t, rng, 0.2)
        origin = TaskContext.get().partitionId()
        for k, n in enumerate(model.PARTS):
            at = np.flatnonzero(model.used[n])
            for a in range(0, len(at), 4096):
                some = at[a : a + 4096]
                rows = getattr(model, n)[some]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1, dtype=np.int32) * rows.shape[1]), pa.array(rows.ravel()))
                yield pa.RecordBatch.from_arrays([pa.array(some * len(model.PARTS) + k), pa.array(np.full(len(some), origin, np.int64)), pa.array(model.used[n][some]), lists], names=["key", "origin", "used", "v"])

    def means(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of a key follow on each other, in order of origin."""
        key, total, used = None, None, 0
        out: list[tuple] = []

        def made() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [(), ()]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.list_(pa.float32()))], names=["key", "v"])

        for batch in it:
            lists = batch.column(3)
            at, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
            for i, (k, n) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                if k != key:
                    if key is not None:
                        out.append((key, (total / used).astype(np.float32)))
                    key, total, used = k, 0.0, 0
                total = total + flat[at[i] : at[i + 1]].astype(np.float64) * n
                used += n
            yield made()
        if key is not None:
            out.append((key, (total / used).astype(np.float32)))
        yield made()

    rows = training.select("text").mapInArrow(batches, "key long, origin long, used long, v array<float>")
    found = rows.repartition("key").sortWithinPartitions("key", "origin").mapInArrow(means, "key long, v array<float>").toArrow()  # bounded by OWN
    keys, lists = found["key"].to_numpy(), found["v"].combine_chunks()
    at, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
    for k, n in enumerate(start.PARTS):
        own = np.flatnonzero(keys % len(start.PARTS) == k)
        if len(own):
            table = getattr(start, n)
            table[keys[own] // len(start.PARTS)] = flat[at[own][:, None] + np.arange(table.shape[1])]
    return start


def score(docs: DataFrame, voc: Vocabulary, model: LogBilinear, counts: DataFrame) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score and score of every text."""
    shared = docs.sparkSession.sparkContext.broadcast((voc, {n: getattr(model, n) for n in model.PARTS}))  # bounded by OWN and FREQUENT

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc, values = shared.value
        model = LogBilinear(voc)
        for n in model.PARTS:
            setattr(model, n, values[n])
        smooth = np.log10(voc.counts + SMOOTH)
        below = np.log10(voc.rest_total())
        base_total, end_log = np.log10(voc.base_total), np.log10(voc.texts + SMOOTH)
        for batch in it:
            raw, offsets = buffers(batch.column(2))
            for a, b in chunks(offsets):
                t, w = tokens_of(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], voc)
                known = t.place >= 0
                log_c = np.where(t.place == -2, end_log, 0.0)
                log_c[known] = smooth[t.place[known]]
                seen = t.place == -2 if voc.texts else np.zeros(len(known), bool)
                seen[known] = voc.counts[t.place[known]] > 0
                unit, inner = model.log_probabilities(t)
                p = (unit + inner) / np.log(10)
                kind = np.where(t.slot >= 0, voc.rest_class[t.slot], -1)
                rest = np.flatnonzero(kind >= 0)
                p[rest] += log_c[rest] - below[kind[rest]]
                base = log_c - base_total
                n = np.diff(np.append(t.first, len(p)))
                rid, doc_id = batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a)
                none, empty = pa.nulls(b - a, pa.int64()), pa.nulls(b - a, pa.int64())
                yield pa.RecordBatch.from_arrays([rid, doc_id, none, empty, pa.array(n), pa.array(np.add.reduceat(seen.astype(np.int64), t.first)), pa.array(np.add.reduceat(base, t.first)), pa.array(np.add.reduceat(p, t.first))], names=names)
                rare = np.flatnonzero(t.place[np.arange(len(w.hash)) + w.doc] < 0)
                if len(rare):
                    doc, h = w.doc[rare], w.hash[rare]
                    order = np.lexsort((h, doc))
                    doc, h = doc[order], h[order]
                    head = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])])
                    m = len(head)
                    yield pa.RecordBatch.from_arrays([rid.take(pa.array(doc[head])), pa.nulls(m, pa.int64()), pa.array(h[head].view(np.int64)), pa.array(np.diff(np.append(head, len(h)))), *[pa.nulls(m, pa.int64())] * 2, *[pa.nulls(m, pa.float64())] * 2], names=names)

    names = ["rid", "doc_id", "h", "tf", "n_tokens", "n_known", "base", "score"]
    made = written(docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "text").mapInArrow(batches, "rid long, doc_id long, h long, tf long, n_tokens long, n_known long, base double, score double"))
    rare = made.where("h IS NOT NULL").select("rid", "h", "tf").join(counts.select("h", "n_train"), "h")
    rare = rare.groupBy("rid").agg(F.sum(F.col("tf") * F.log10(F.col("n_train") + SMOOTH)).alias("s"), F.sum(F.when(F.col("n_train") > 0, F.col("tf")).otherwise(0)).alias("k"))
    whole = made.where("h IS NULL").select("rid", "doc_id", "n_tokens", "n_known", "base", "score").join(rare, "rid", "left")
    s, k = F.coalesce("s", F.lit(0.0)), F.coalesce("k", F.lit(0))
    return whole.select("doc_id", "n_tokens", (F.col("n_known") + k).alias("n_known"), (F.col("base") + s).alias("base_score"), (F.col("score") + s).alias("score"))


def op7_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir).select("doc_id", "text")
    train = remainder("doc_id", 10) != 0
    counts = written(count_words(docs, train))
    training = docs.where(train)
    voc = vocabulary(counts, training.count())
    scored = score(docs, voc, trained(training, voc), counts)
    return scored.select("doc_id", (remainder("doc_id", 10) == 0).alias("held_out"), "n_tokens", "n_known", F.lit(voc.tokens).cast("long").alias("train_tokens"), "base_score", "score")
