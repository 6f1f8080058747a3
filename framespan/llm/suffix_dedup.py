"""Removal of repeated byte strings by a hash-compared suffix sort.

A byte goes when a string of `length` bytes that covers it also starts anywhere else, in any document.

Every window of `length` bytes has an anchor, the leftmost of its `gram`-byte strings with the least hash; equal
windows have equal anchors at equal places, so windows only need to be compared when their anchors' strings are the
same.  One pass finds the anchors and counts them; anchors that occur once are dropped.  For the others the bytes around
(all windows of that anchor) are brought together by anchor.  There the suffixes from the anchor on, and the
reversed prefixes before it, are sorted by a mergesort that compares two suffixes in logarithmic time: a binary search
over polynomial prefix hashes finds their common extension, the next byte decides.  Common extensions of neighbours are
verified byte by byte.  Windows are equal when they lie in one run of common extensions on both sides.

Equal texts are known by their hashes (128 bits) and are one text in all this; all bytes of a text with a copy go.  An
anchor with more than HOT surroundings is dealt again by longer strings: its windows are parted by where the anchor lies
in them, into two parts, then four and so on, and the windows of a part have more bytes in common with the anchor, which
become the key.  Surroundings that are equal byte by byte become one first, whose windows are all repeated.  With one
place a part the key is the window, so every anchor ends in groups of at most HOT different surroundings, which all go
through the same suffix sort.  Long texts are worked on in overlapping pieces.

Defined cases: null is the empty text; texts shorter than `length` keep all; repeated rows count as other places; rows
with one doc_id are worked on each by itself; an empty table gives no rows; only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framespan.llm._common import discard, read_documents, written
from framespan.llm._vec import _BYTES, buffers, chunks, mix, powers
from framespan.llm.decontamination import bloom, passes

LENGTH, GRAM = 200, 50
#: bytes of a long text's piece
PIECE = 1 << 21
#: surroundings of one anchor that are compared in one task
HOT = 2000
#: repeated anchors that are broadcast; more are joined by shuffle, behind a Bloom filter
BROADCAST_ROWS = 1_000_000
#: texts whose surroundings a task remembers, to skip copies
MET = 1_000_000


class Prefix:
    """Polynomial prefix hashes of a buffer: any substring's hash in constant time."""

    def __init__(self, raw: np.ndarray):
        up, self.down = powers(len(raw) + 1)
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_BYTES[raw] * up[: len(raw)], out=self.sums[1:])

    def of(self, start: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        return (self.sums[start + size] - self.sums[start]) * self.down[start]


def anchors(raw: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(document, first window, last window, anchor place, anchor hash) of every run of windows with one anchor."""
    n = len(raw)
    count = n - length + 1
    if count < 1:
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),)
    prefix = Prefix(raw)
    hashes = mix(prefix.of(np.arange(n - gram + 1), gram))
    width = length - gram + 1
    places = 24
    key = (hashes >> np.uint64(places) << np.uint64(places)) | np.arange(len(hashes), dtype=np.uint64)
    padded = np.concatenate([key, np.full(-len(key) % width, np.iinfo(np.uint64).max)]).reshape(-1, width)
    ahead = np.minimum.accumulate(padded, 1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], 1)[:, ::-1].ravel()
    least = np.minimum(behind[:count], ahead[width - 1 : width - 1 + count])
    place = (least & np.uint64((1 << places) - 1)).astype(np.int64)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:count]
    start = np.flatnonzero(np.arange(count) + length <= offsets[1:][doc])
    place, doc = place[start], doc[start]
    new = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (doc[1:] != doc[:-1])]) if len(start) else np.zeros(0, np.int64)
    last = start[np.r_[new[1:] - 1, len(start) - 1]] if len(start) else new
    return doc[new], start[new], last, place[new], hashes[place[new]]


def surroundings(docs: DataFrame, *, length: int, gram: int, with_bytes: bool, among: tuple[np.ndarray, int] | None = None) -> DataFrame:
    """h, k1, k2, first places, the anchor's offset and (if asked for) the bytes of each anchor's windows.

    Equal surroundings of one text are one row with several places.  Copies of a text met in a task are skipped, and so
    are anchors that the Bloom filter `among` does not hold."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[tuple[int, int]] = set()
        for batch in it:
            raw, offsets = buffers(batch.column(2))
            keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            fresh = np.zeros(len(keys), bool)
            for d, key in enumerate(keys):
                if key not in met and offsets[d + 1] - offsets[d] >= length:
                    if len(met) >= MET:
                        met.clear()
                    met.add(key)
                    fresh[d] = True
            for a, b in chunks(offsets):
                for d0, base, part, at in pieces(raw, offsets, a, b, length):
                    yield from rows(part, at, base, d0, keys, fresh)

    def pieces(raw, offsets, a, b, length):
        if b - a > 1 or offsets[b] - offsets[a] <= PIECE:
            yield a, 0, raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            return
        for start in range(int(offsets[a]), int(offsets[b]) - length + 1, PIECE):
            part = raw[start : min(start + PIECE + length - 1, int(offsets[b]))]
            yield a, start - int(offsets[a]), part, np.array([0, len(part)])

    def rows(part, at, base, d0, keys, fresh) -> Iterator[pa.RecordBatch]:
        doc, first, last, place, hashes = anchors(part, at, length, gram)
        keep = fresh[d0 + doc]
        if among:
            held = np.zeros(len(keep), bool)
            held[passes(*among, hashes)] = True
            keep &= held
        doc, first, last, place, hashes = doc[keep], first[keep], last[keep], place[keep], hashes[keep]
        if not len(doc):
            return
        size = last - first + length
        whole = mix(Prefix(part).of(first, size) + size.astype(np.uint64))
        order = np.lexsort((first, place - first, whole, hashes, doc))
        doc, first, place, hashes, size, whole = (x[order] for x in (doc, first, place, hashes, size, whole))
        off = place - first
        same = (doc[1:] == doc[:-1]) & (hashes[1:] == hashes[:-1]) & (whole[1:] == whole[:-1]) & (off[1:] == off[:-1]) & (size[1:] == size[:-1])
        for i in np.flatnonzero(same):  # verified: equal bytes, not only equal hashes
            same[i] = np.array_equal(part[first[i] : first[i] + size[i]], part[first[i + 1] : first[i + 1] + size[i + 1]])
        head = np.flatnonzero(np.r_[True, ~same])
        starts = pa.ListArray.from_arrays(pa.array(np.r_[head, len(doc)].astype(np.int32)), pa.array(first - at[doc] + base, pa.int64()))
        own = [keys[d0 + d] for d in doc[head]]
        columns = [pa.array(hashes[head].view(np.int64)), pa.array([k for k, _ in own], pa.int64()), pa.array([k for _, k in own], pa.int64()), starts, pa.array(off[head], pa.int32())]
        if with_bytes:
            columns.append(pa.array([part[x : x + n].tobytes() for x, n in zip(first[head], size[head], strict=True)], pa.binary()))
        yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["h", "k1", "k2", "starts", "off"] + ["around"] * with_bytes
    return docs.select("k1", "k2", "text").mapInArrow(batches, "h long, k1 long, k2 long, starts array<long>, off int" + ", around binary" * with_bytes)


def common_extension(prefix: Prefix, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Bytes that the suffixes at a and b share, at most `most`, by binary search over prefix hashes."""
    low, high = np.zeros_like(most), most.copy()
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low
        mid = (low[open_] + high[open_] + 1) >> 1
        equal = prefix.of(a[open_], mid) == prefix.of(b[open_], mid)
        low[open_] = np.where(equal, mid, low[open_])
        high[open_] = np.where(equal, high[open_], mid - 1)


def suffix_sort(raw: np.ndarray, start: np.ndarray, size: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes inside each group (groups are runs), and each one's verified extension with the one before.

    All groups are merge-sorted at once, runs of doubling width; an element's place in a merge is found by a binary
    search in the other run."""
    n, prefix = len(start), Prefix(raw)
    padded = np.append(raw, np.uint8(0))
    opens = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if n else np.zeros(0, np.int64)
    sizes = np.diff(np.r_[opens, n])
    base, end = np.repeat(opens, sizes), np.repeat(opens + sizes, sizes)
    order = np.arange(n)

    def before(x: np.ndarray, y: np.ndarray, ties: np.ndarray) -> np.ndarray:
        """Whether suffix y comes before suffix x; ties says what equal ones give."""
        most = np.minimum(size[x], size[y])
        shared = common_extension(prefix, start[x], start[y], most)
        inside = shared < most
        mine = np.where(inside, padded[np.minimum(start[x] + shared, len(raw))], 0).astype(np.int64)
        other = np.where(inside, padded[np.minimum(start[y] + shared, len(raw))], 0).astype(np.int64)
        return np.where(inside, other < mine, np.where(size[x] == size[y], ties, size[y] < size[x]))

    width = 1
    while n and width < sizes.max():
        live = np.flatnonzero(end - base > width)
        rel = live - base[live]
        left = (rel // width) % 2 == 0
        run = base[live] + rel // (2 * width) * (2 * width)
        middle, stop = np.minimum(run + width, end[live]), np.minimum(run + 2 * width, end[live])
        low = np.where(left, middle, run)
        high = np.where(left, stop, middle)
        origin = low.copy()
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            mid = (low[open_] + high[open_]) >> 1
            less = before(order[live[open_]], order[mid], ~left[open_])
            low[open_] = np.where(less, mid + 1, low[open_])
            high[open_] = np.where(less, high[open_], mid)
        to = run + (live - np.where(left, run, middle)) + (low - origin)
        merged = order.copy()
        merged[to] = order[live]
        order = merged
        width *= 2
    shared = np.zeros(n, np.int64)
    if n > 1:
        a, b = order[:-1], order[1:]
        most = np.where(group[a] == group[b], np.minimum(size[a], size[b]), 0)
        shared[1:] = verified(raw, start[a], start[b], common_extension(prefix, start[a], start[b], most))
    return order, shared


def verified(raw: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The extensions, cut at the first byte that differs after all."""
    if not len(size) or not size.sum():
        return size
    own = np.repeat(np.arange(len(size)), size)
    step = np.arange(len(own)) - np.repeat(np.cumsum(size) - size, size)
    wrong = np.flatnonzero(raw[a[own] + step] != raw[b[own] + step])
    if len(wrong):
        size = size.copy()
        np.minimum.at(size, own[wrong], step[wrong])
    return size


def repeated_windows(around: list[bytes], off: np.ndarray, group: np.ndarray, multiple: np.ndarray, length: int) -> list[np.ndarray]:
    """For each surrounding the windows (by place of their first byte in it) that another one of its group holds too."""
    raw = np.frombuffer(b"".join(around), np.uint8)
    size = np.array([len(x) for x in around])
    at = np.cumsum(size) - size
    right, right_lcp = suffix_sort(raw, at + off, size - off, group)
    mirror = raw[::-1]
    left, left_lcp = suffix_sort(mirror, len(raw) - at - off, off.copy(), group)
    n = len(around)
    found = np.zeros((n, length), bool)
    run, back = np.empty(n, np.int64), np.empty(n, np.int64)
    new_group = np.r_[True, group[1:] != group[:-1]]
    for before in range(int(off.max()) + 1):
        has = np.flatnonzero((off >= before) & (size - off >= length - before))
        if not len(has):
            continue
        run[right] = np.cumsum((right_lcp < length - before) | new_group)
        back[left] = np.cumsum((left_lcp < before) | new_group)
        _, inverse, count = np.unique(run[has] * (n + 1) + back[has], return_inverse=True, return_counts=True)
        hit = has[(count[inverse] > 1) | multiple[has]]
        found[hit, off[hit] - before] = True
    return [np.flatnonzero(found[i]) for i in range(n)]


def spans_of(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Joined spans [first, end) of the windows that begin at the ascending starts."""
    if not len(starts):
        return []
    cut_ = np.flatnonzero(np.diff(starts) > length)
    return list(zip(starts[np.r_[0, cut_ + 1]].tolist(), (starts[np.r_[cut_, len(starts) - 1]] + length).tolist(), strict=True))


def grouped_spans(brought: DataFrame, length: int) -> DataFrame:
    """k1, k2, first, last of the repeated windows; rows of an anchor must lie together in a partition, in order.

    many: all windows of the row are repeated, whatever the others are."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in it:
            h = batch.column(0).to_numpy()
            held += zip(h.tolist(), *(batch.column(i).to_pylist() for i in range(1, 7)), strict=True)
            done = int(np.searchsorted(np.fromiter((r[0] for r in held), np.int64, len(held)), held[-1][0])) if held else 0
            if done > 2000:
                yield work(held[:done])
                held = held[done:]
        if held:
            yield work(held)

    def work(rows: list[tuple]) -> pa.RecordBatch:
        seen, kept = set(), []
        for r in rows:  # copies of a text that came from several tasks
            key = (r[0], r[1], r[2], r[3][0])
            if key not in seen:
                seen.add(key)
                kept.append(r)
        _, group = np.unique(np.array([r[0] for r in kept]), return_inverse=True)
        multiple = np.array([r[6] or len(r[3]) > 1 for r in kept])
        windows = repeated_windows([r[5] for r in kept], np.array([r[4] for r in kept], np.int64), group, multiple, length)
        out: list[tuple[int, int, int, int]] = []
        for r, w in zip(kept, windows, strict=True):
            out += [(r[1], r[2], s + a, s + b) for a, b in spans_of(w, length) for s in r[3]]
        columns = list(zip(*out, strict=True)) if out else [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["k1", "k2", "first", "last"])

    dealt = brought.select("h", "k1", "k2", "starts", "off", "around", "many").repartition("h").sortWithinPartitions("h")
    return dealt.mapInArrow(batches, "k1 long, k2 long, first long, last long")


def parted(around: DataFrame, parts: int, *, length: int, gram: int) -> DataFrame:
    """The surroundings with their windows parted by the anchor's place in them; h is the hash of the bytes that all
    windows of a part share, and of the old h."""
    places = length - gram + 1
    width = -(-places // parts)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            columns: list[list] = [[] for _ in names]
            for h, k1, k2, starts, off, data, many in zip(*(batch.column(i).to_pylist() for i in range(7)), strict=True):
                for part in range((off + length - len(data)) // width, off // width + 1):
                    low, high = part * width, min(part * width + width, places) - 1
                    key = hashlib.blake2b(data[off - low : off + length - high], digest_size=8, salt=part.to_bytes(8, "little"), person=h.to_bytes(8, "little", signed=True))
                    least, most = max(low, off + length - len(data)), min(high, off)  # bytes before the anchor in these windows
                    row = (int.from_bytes(key.digest(), "little", signed=True), k1, k2, [s + off - most for s in starts], most, data[off - most : off + length - least], many)
                    for column, value in zip(columns, row, strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    names = ["h", "k1", "k2", "starts", "off", "around", "many"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.binary(), pa.bool_()]
    return around.select(*names).mapInArrow(batches, "h long, k1 long, k2 long, starts array<long>, off int, around binary, many boolean")


def hot_spans(around: DataFrame, *, length: int, gram: int, hot: int) -> list[DataFrame]:
    """Tables of k1, k2, first, last of the repeated windows of anchors with very many surroundings."""
    found, parts = [], 2
    while around.limit(1).count():
        made = written(parted(around, parts, length=length, gram=gram))
        # equal bytes are one: all windows of each are repeated, one stays for the others
        equal = made.groupBy("h", "off", "around").agg(F.sum(F.size("starts")).alias("n"), F.min("k1").alias("k1"), F.max("many").alias("many"))
        equal = written(equal.withColumn("many", F.col("many") | (F.col("n") > 1)))
        whole = made.join(equal.where("many").select("h", "off", "around"), ["h", "off", "around"])
        found.append(written(whole.select("k1", "k2", F.explode("starts").alias("first"), F.octet_length("around").alias("size")).select("k1", "k2", "first", (F.col("first") + F.col("size")).alias("last"))))
        one = made.withColumn("place", F.struct("k2", "starts")).groupBy("h", "off", "around").agg(F.min(F.struct("k1", "place")).alias("p"))
        one = one.join(equal.select("h", "off", "around", "many"), ["h", "off", "around"]).select("h", "p.k1", "p.place.k2", "p.place.starts", "off", "around", "many")
        sizes = equal.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        left = written(one.join(sizes, "h"))
        found.append(written(grouped_spans(left.where(F.col("n") <= hot), length)))
        around, parts = left.where(F.col("n") > hot).drop("n"), parts * 2
        discard(made, equal)
    return found


def remove_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """doc_id, kept bytes, n_bytes, n_removed and n_spans; spans: k1, k2 and spans array<struct<first, last>>."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            kept, size, removed, runs = [], [], [], []
            for text, cuts in zip(batch.column(1), batch.column(2).to_pylist(), strict=True):
                data = (text.as_py() or "").encode()
                parts, to, n = [], 0, 0
                for cut_ in sorted((c["first"], c["last"]) for c in cuts or ()):
                    if cut_[0] > to or not n:
                        parts.append(data[to : cut_[0]])
                        n += 1
                    to = max(to, cut_[1])
                parts.append(data[to:])
                rest = b"".join(parts)
                for values, v in ((kept, rest), (size, len(data)), (removed, len(data) - len(rest)), (runs, n)):
                    values.append(v)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.binary()), *[pa.array(v, pa.int64()) for v in (size, removed, runs)]], names=["doc_id", "kept", "n_bytes", "n_removed", "n_spans"])

    joined = docs.join(spans, ["k1", "k2"], "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(batches, "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long")


def remove_repeats(docs: DataFrame, *, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """doc_id, kept (the bytes that stay), n_bytes, n_removed and n_spans of every document."""
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(7), "text", F.lit(9)).alias("k2"))
    keyed = keyed.withColumns({"k1": F.coalesce("k1", F.lit(0)), "k2": F.coalesce("k2", F.lit(0))})
    places = surroundings(keyed, length=length, gram=gram, with_bytes=False).select("h", "k1", F.col("starts")[0].alias("s"), (F.size("starts") > 1).alias("many"))
    repeated = places.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("k1").alias("a"), F.max("k1").alias("b"), F.min("s").alias("c"), F.max("s").alias("d"), F.max("many").alias("m")).where("a < b OR c < d OR m").select("h", "n")
    repeated = written(repeated)
    few = repeated.count() <= BROADCAST_ROWS
    # where they are too many to be sent to every task, a filter of bounded size drops most others before bytes are moved
    among = None if few else bloom(repeated.select(F.col("h").alias("seed")))
    around = surroundings(keyed, length=length, gram=gram, with_bytes=True, among=among).join(F.broadcast(repeated) if few else repeated, "h")
    around = written(around.withColumn("many", F.lit(False)))
    tables = [grouped_spans(around.where(F.col("n") <= hot), length)]
    if repeated.where(F.col("n") > hot).limit(1).count():
        tables += hot_spans(around.where(F.col("n") > hot).drop("n"), length=length, gram=gram, hot=hot)
    copies = keyed.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n"), F.max(F.octet_length("text")).cast("long").alias("last")).where((F.col("n") > 1) & (F.col("last") >= length))
    tables.append(copies.select("k1", "k2", F.lit(0).cast("long").alias("first"), "last"))
    spans = reduce(DataFrame.union, tables).groupBy("k1", "k2").agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    return remove_spans(keyed, spans)


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(read_documents(spark, sf_dir))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


#: all windows as rows; repeated ones joined to spans, and what lies between spans put together
ORACLE_SQL = """
WITH d AS (SELECT row_number() OVER () AS row_id, doc_id, encode(coalesce(text, '')) AS b FROM documents),
w AS (SELECT row_id, unnest(range(1, octet_length(b) - 198)) AS i FROM d WHERE octet_length(b) >= 200),
v AS (SELECT w.row_id, i, b[i:i + 199] AS s FROM w JOIN d USING (row_id)),
r AS (SELECT row_id, i FROM (SELECT row_id, i, count(*) OVER (PARTITION BY s) AS n FROM v) WHERE n > 1),
e AS (SELECT row_id, i, sum(fresh) OVER (PARTITION BY row_id ORDER BY i) AS g FROM (SELECT row_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY row_id ORDER BY i) <= 200 THEN 0 ELSE 1 END AS fresh FROM r)),
p AS (SELECT row_id, g, min(i) AS a, max(i) + 199 AS z FROM e GROUP BY ALL),
k AS (SELECT row_id, a, z, coalesce(lag(z) OVER (PARTITION BY row_id ORDER BY a), 0) AS before FROM p),
x AS (SELECT d.row_id, count(*) AS n_spans, sum(z - a + 1) AS n_removed, unhex(string_agg(hex(b[before + 1:a - 1]), '' ORDER BY a)) || (any_value(b))[max(z) + 1:] AS kept FROM k JOIN d USING (row_id) GROUP BY 1)
SELECT doc_id, octet_length(b)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(coalesce(kept, b)) AS kept_sha256 FROM d LEFT JOIN x USING (row_id)
"""
