"""Exact n-gram Jaccard join by prefix trees.

A document's set is its distinct word n-grams as 64-bit tokens in one global order.  Documents with equal sets are one
class.  Of two sets that reach the similarity the first p + k - 1 tokens share k at least, p being the tokens that may
be missing, plus one; k is about half of p.  A set of whose first tokens fewer than k occur elsewhere has no link.  Among
the first tokens, rarest first, the same bound leaves a second prefix, of which one token at least is shared.

Sets are compared in tries: the most common token first, so that sets share their beginnings; a set is looked up by
walking the trie with the overlap so far, and a subtree is left when the tokens that remain on either side cannot raise
the overlap far enough for its set sizes.  What comes out are links of a spanning forest.  Two rounds do this.  First
every set is compared with the pivot it shares most second-prefix tokens with, the least class that holds them, in blocks
of bounded size: near copies of one text become one component there, however many they are, and each set is moved once.
Then only tokens that are held in two or more components are left.  The components that meet in them, or, where that moves
fewer sets, the sets of each such token are compared, long lists by pairs of blocks, without pairs of blocks of one
component.

The global order puts tokens with many letters first and tokens that many documents of a sample hold last; any order
gives the same links, this one makes lists short.  Pairs of documents are never written, no group is collected whole.
What stays quadratic, in blocks, are sets that share a rare token, more than BLOCK_SETS of them, without being similar.

Defined cases: texts without words and nulls have empty sets and are linked with nothing; texts of fewer than n words
have one token; equal rows are one class; rows with one doc_id and different texts are told apart by the text's hash and
take the least doc_id of their own component; very long texts are whole sets like all others; an empty table gives no
rows; only doc_id and text are read.  Tokens are 64-bit hashes: two different n-grams share one with a chance of about
2**-56.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from framespan.llm._common import BROADCAST_ROWS, discard, free_name, read_documents, text_hash, without, written
from framespan.llm._graph import components
from framespan.llm._vec import buffers, chunks, mix, release, runs, words

#: documents of the sample that the token order is taken from; it changes the work, never the links
ORDER_SAMPLE = 5000
#: most tokens with a place of their own at the end of the order
COMMON = 1 << 18
#: sets and tokens of a block
BLOCK_SETS, BLOCK_TOKENS = 100, 200_000


def token_sets(raw: np.ndarray, offsets: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """For each document its tokens in ascending order: 8 bits of length (longer first), 56 bits of hash."""
    w = words(raw, offsets)
    size = np.concatenate([[0], np.cumsum(w.end - w.start)])
    value, to = runs(w.hash, w.at, width)
    counts = np.diff(w.at)
    first = np.arange(len(value)) + np.repeat(w.at[:-1] - to[:-1], np.diff(to))
    letters = np.minimum(size[first + width] - size[first], 255).astype(np.uint64) if len(first) else np.zeros(0, np.uint64)
    tokens = ((np.uint64(255) - letters) << np.uint64(56)) | (value >> np.uint64(8))
    for d, n in enumerate(counts):
        if n >= width:
            yield np.unique(tokens[to[d] : to[d + 1]])
        elif n:
            whole = np.array([n], np.uint64)
            for k in range(w.at[d], w.at[d + 1]):
                whole = mix(whole + w.hash[k : k + 1])
            yield whole >> np.uint64(8)
        else:
            yield np.zeros(0, np.uint64)


def missing(n: str, percent: int) -> str:
    """SQL of p: tokens that a set of n may have besides those shared, plus one."""
    return f"({n} - ({n} * {percent} + 99) div 100 + 1)"


def wanted(n: str, percent: int) -> str:
    """SQL of k: tokens that the first p + k - 1 share at least.  Grows with n."""
    return f"greatest(1L, {missing(n, percent)} div 2)"


def prefix_size(n: int, percent: int) -> int:
    """p + k - 1."""
    p = n - -(-n * percent // 100) + 1
    return min(n, p + max(1, p // 2) - 1)


def second_prefix(firsts: DataFrame, percent: int) -> DataFrame:
    """cls and t: of two sets that can reach the similarity one token t at least is shared here; firsts: cls, n and prefix.

    What a set shares with another it shares with one of 85 % (`percent`) of its size at least, so k of that size is
    the bound."""
    postings = firsts.select("cls", "n", F.size("prefix").alias("taken"), F.explode("prefix").alias("t"))
    often = postings.groupBy("t").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    shared = postings.join(often, "t")
    own = Window.partitionBy("cls")  # bounded by the prefix
    ranked = shared.select("*", F.count(F.lit(1)).over(own).alias("met"), F.row_number().over(own.orderBy("df", "t")).alias("rank"))
    least = wanted(f"((n * {percent} + 99) div 100)", percent)
    kept = ranked.where(f"met >= {least} AND taken - met + rank <= taken - {least} + 1").select("cls", "t")
    held = kept.groupBy("t").agg(F.min("cls").alias("least"), F.max("cls").alias("most")).where("least < most").select("t", "least")
    return kept.join(held, "t")


def common_tokens(docs: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens that two or more documents of a sample hold, ascending, and their counts; COMMON at most."""
    total = docs.count()

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in it:
            raw, offsets = buffers(batch.column(0))
            for a, b in chunks(offsets):
                found = [t.view(np.int64) for t in token_sets(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], width)]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found))], names=["t"])

    sample = docs.select("text").sample(min(1.0, ORDER_SAMPLE / max(total, 1)), 5) if total > ORDER_SAMPLE else docs.select("text")
    found = sample.mapInArrow(batches, "t long").groupBy("t").count().where("count > 1").orderBy(F.desc("count"), "t").limit(COMMON).toArrow()
    tokens, n = found["t"].to_numpy().view(np.uint64), found["count"].to_numpy()
    order = np.argsort(tokens)
    return tokens[order], n[order]


def signatures(docs: DataFrame, common: tuple[np.ndarray, np.ndarray], *, width: int, percent: int) -> DataFrame:
    """doc_id, hash of the text, size and 128-bit signature of the set, and its prefix in the global order."""
    shared = docs.sparkSession.sparkContext.broadcast(common)  # bounded by COMMON

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        tokens, often = shared.value
        for batch in it:
            raw, offsets = buffers(batch.column(2))
            for a, b in chunks(offsets):
                n, s1, s2, prefix = [], [], [], []
                for t in token_sets(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], width):
                    n.append(len(t))
                    m = mix(t)
                    s1.append(int(m.sum().view(np.int64)) if len(t) else 0)
                    s2.append(int(mix(m + np.uint64(77)).sum().view(np.int64)) if len(t) else 0)
                    if len(tokens) and len(t):
                        at = np.minimum(np.searchsorted(tokens, t), len(tokens) - 1)
                        count = np.where(tokens[at] == t, often[at], 0)
                        t = t[np.argsort(count, kind="stable")]
                    prefix.append(t[: prefix_size(len(t), percent)].view(np.int64) if len(t) else np.zeros(0, np.int64))
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(a, b - a) for i in (0, 1)), pa.array(n, pa.int64()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()), pa.array(prefix, pa.list_(pa.int64()))], names=["doc_id", "th", "n", "s1", "s2", "prefix"])

    return docs.select("doc_id", "th", "text").mapInArrow(batches, "doc_id long, th long, n long, s1 long, s2 long, prefix array<long>")


class Node:
    """A trie node: the tokens on its edge as bits, what is below it, and the sets that end here."""

    __slots__ = ("bits", "children", "ends", "last", "least", "most", "rest")


def build_trie(sets: list[tuple[int, ...]], sizes: list[int]) -> Node:
    """Trie of ascending token numbers; chains without branches are one node."""
    order = sorted(range(len(sets)), key=sets.__getitem__)
    root, work = Node(), []
    work.append((root, 0, len(order), 0))
    made = []
    while work:
        node, lo, hi, depth = work.pop()
        first, final = sets[order[lo]], sets[order[hi - 1]]
        to = depth
        while to < len(first) and to < len(final) and first[to] == final[to]:
            to += 1
        bits = 0
        for t in first[depth:to]:
            bits |= 1 << t
        node.bits, node.last = bits, first[to - 1] if to else -1
        at = lo
        while at < hi and len(sets[order[at]]) == to:
            at += 1
        node.ends, node.children = order[lo:at], []
        members = order[lo:hi]
        node.least, node.most = min(sizes[i] for i in members), max(sizes[i] for i in members)
        node.rest = max(len(sets[i]) for i in members) - to
        while at < hi:
            token, end = sets[order[at]][to], at
            while end < hi and sets[order[end]][to] == token:
                end += 1
            child = Node()
            node.children.append(child)
            work.append((child, at, end, to))
            at = end
        made.append(node)
    return root


def trie_links(tokens: list[np.ndarray], sizes: list[int], side: list[int], percent: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of the sets that reach the similarity; side: 0 and 1 are only compared with each
    other, 2 with all."""
    every, where, count = np.unique(np.concatenate(tokens), return_inverse=True, return_counts=True)
    rank = np.empty(len(every), np.int64)
    rank[np.lexsort((every, -count))] = np.arange(len(every))
    seen = count > 1  # a token of one set alone can't be in an overlap
    at, numbers = 0, []
    for t in tokens:
        own = where[at : at + len(t)]
        at += len(t)
        numbers.append(tuple(np.sort(rank[own[seen[own]]]).tolist()))
    stored = [i for i, s in enumerate(side) if s != 0]
    asked = [i for i, s in enumerate(side) if s != 1]
    root = build_trie([numbers[i] for i in stored], [sizes[i] for i in stored])
    parent = list(range(len(tokens)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    links = []
    for q in asked:
        mine, n = 0, sizes[q]
        for t in numbers[q]:
            mine |= 1 << t
        walk = [(root, 0)]
        while walk:
            node, overlap = walk.pop()
            if 100 * node.most < percent * n or 100 * n < percent * node.least:
                continue
            overlap += (node.bits & mine).bit_count()
            left = min(node.rest, (mine >> (node.last + 1)).bit_count())
            if (100 + percent) * (overlap + left) < percent * (n + node.least):
                continue
            for k in node.ends:
                i = stored[k]
                if i != q and (100 + percent) * overlap >= percent * (n + sizes[i]):
                    a, b = find(q), find(i)
                    if a != b:
                        parent[max(a, b)] = min(a, b)
                        links.append((q, i))
            walk += [(child, overlap) for child in node.children]
    return links


def star(links: list[tuple[int, int]], n: int) -> list[tuple[int, int]]:
    """Links from every one of n nodes to the least that it can reach."""
    parent = list(range(n))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [(k, find(k)) for k in range(n) if find(k) != k]


def compared(docs: DataFrame, places: DataFrame, *, width: int, percent: int, repeated: DataFrame | None = None) -> DataFrame:
    """Links (a, b) between classes, stars within each list; places: doc_id and th of a class's text, cls, the task and list it is compared in,
    and side (0 and 1 are only compared with each other, 2 with all).

    repeated: doc_id and th of rows that are in docs more than once, if any: of these one row a class is left, in each task
    and then of all, before its words are made, so that copies of a row weigh nothing afterwards."""
    keys = ["cls", "task", "list", "side"]

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in it:
            raw, offsets = buffers(batch.column(2))
            for a, b in chunks(offsets):
                sets = pa.array([t.tobytes() for t in token_sets(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], width)], pa.binary())
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(a, b - a) for i in (0, 1)), sets], names=["cls", "at", "tokens"])

    # a class's places become one row, so that its text is cut into words once
    texts = places.groupBy("doc_id", "th", "cls").agg(F.collect_list(F.struct("task", "list", "side")).alias("at"))
    few = places.select("doc_id").count() <= BROADCAST_ROWS
    texts = F.broadcast(texts) if few else texts
    found = docs.join(texts, ["doc_id", "th"]).select("cls", "at", "text")
    if repeated is not None:
        key = ["doc_id", "th"]
        once = docs.join(texts.join(repeated, key, "left_anti"), key).select("cls", "at", "text")
        found = once.union(docs.join(texts.join(repeated, key, "left_semi"), key).groupBy("cls").agg(F.first("at").alias("at"), F.first("text").alias("text")))
    at = "at array<struct<task:long,list:long,side:int>>"
    sets = found.mapInArrow(batches, f"cls long, {at}, tokens binary").select("cls", F.explode("at").alias("at"), "tokens")
    sets = sets.select("cls", "at.task", "at.list", "at.side", "tokens")

    def links(group: pd.DataFrame) -> pd.DataFrame:
        a, b = [], []
        for _, part in group.sort_values(["list", "cls"]).groupby("list", sort=False):
            side = part["side"].tolist()
            if len(part) > 1 and (2 in side or len(set(side)) > 1):
                tokens, ids = [np.frombuffer(x, np.uint64) for x in part["tokens"]], part["cls"].to_numpy()
                found = star(trie_links(tokens, [len(t) for t in tokens], side, percent), len(tokens))
                a += [ids[i] for i, _ in found]
                b += [ids[j] for _, j in found]
        return pd.DataFrame({"a": a, "b": b}, dtype="int64")

    assert sets.columns == [*keys, "tokens"]
    return sets.groupBy("task").applyInPandas(links, "a long, b long")


def pivot_places(kept: DataFrame, classes: DataFrame) -> DataFrame:
    """First round: every class beside its pivot, in blocks; the pivot is in each block of its own."""
    met = kept.where("cls <> least").groupBy("cls", "least").agg(F.count(F.lit(1)).alias("n"))
    own = met.groupBy("cls").agg(F.max(F.struct("n", (-F.col("least")).alias("pivot"))).alias("m")).select("cls", (-F.col("m.pivot")).alias("pivot"))
    own = own.join(classes.select("cls", "n", "doc_id", "th"), "cls")
    sizes = own.groupBy("pivot").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_SETS), F.ceil(F.sum("n") / BLOCK_TOKENS)).cast("int").alias("blocks"))
    task = F.xxhash64("pivot", "block")
    members = own.join(sizes, "pivot").withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    members = members.select("cls", "doc_id", "th", task.alias("task"), "pivot")
    pivots = sizes.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).join(classes.select(F.col("cls").alias("pivot"), "doc_id", "th"), "pivot")
    pivots = pivots.select(F.col("pivot").alias("cls"), "doc_id", "th", task.alias("task"), "pivot")
    return members.union(pivots).select("cls", "doc_id", "th", "task", F.col("pivot").alias("list"), F.lit(2).alias("side"))


def open_places(kept: DataFrame, roots: DataFrame, classes: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Second round: classes that share a token which two or more components hold.

    Components that meet in such a token, directly or by others, are a bundle.  A bundle is compared as one list of its
    classes or, where that moves fewer sets, as the lists of its tokens, equal lists once; so a bundle that chance has
    chained together does not pay for its size.  Also gives the tables that the result reads.  Short lists are dealt to
    tasks by hash, some at a time.  The classes of a long list are dealt to blocks, those of one large component to blocks
    of its own, and blocks are paired."""
    named = kept.select("cls", "t").join(roots.select(F.col("node").alias("cls"), "root"), "cls", "left").select("t", "cls", F.coalesce("root", "cls").alias("root"))
    named = written(named)
    lists = named.groupBy("t").agg(F.min("root").alias("r1"), F.max("root").alias("r2"), F.count(F.lit(1)).alias("size"), F.sum(F.xxhash64("cls").cast("decimal(38,0)")).alias("h1"), F.sum(F.xxhash64(F.lit(3), "cls").cast("decimal(38,0)")).alias("h2")).where("r1 < r2")
    lists = lists.groupBy("size", "h1", "h2").agg(F.min("t").alias("t"), F.min("r1").alias("r1"))
    held = written(named.join(lists.select("t", "r1", "size"), "t"))
    bundles = components(held.where("root <> r1").select(F.col("root").alias("a"), F.col("r1").alias("b")))
    held = held.join(bundles.select(F.col("node").alias("root"), F.col("root").alias("bundle")), "root")
    moved = lambda n: n * F.ceil(n / BLOCK_SETS)  # noqa: E731  sets that a list of n moves
    together = held.select("bundle", "cls", "root").distinct()
    sizes = together.groupBy("bundle").agg(F.count(F.lit(1)).alias("m"))
    apart = held.groupBy("bundle", "t").agg(F.max("size").alias("size")).groupBy("bundle").agg(F.sum(moved(F.col("size"))).alias("apart"))
    chosen = sizes.join(apart, "bundle").select("bundle", "m", (moved(F.col("m")) <= F.col("apart")).alias("whole"))
    members = together.join(chosen.where("whole"), "bundle").select(F.col("bundle").alias("list"), F.col("m").alias("size"), "cls", "root")
    members = members.union(held.join(chosen.where("NOT whole"), "bundle").select(F.col("t").alias("list"), "size", "cls", "root"))
    members = written(members.join(classes.select("cls", "n", "doc_id", "th"), "cls"))
    short = F.col("size") <= BLOCK_SETS
    total = members.groupBy(short.alias("short")).agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("n")).collect()
    small = next((r for r in total if r["short"]), {"c": 0, "n": 0})
    tasks = 1 + max(small["c"] // BLOCK_SETS, small["n"] // BLOCK_TOKENS)
    whole = members.where(short).select("cls", "doc_id", "th", F.pmod(F.xxhash64("list"), F.lit(tasks)).alias("task"), "list", F.lit(2).alias("side"))
    if all(r["short"] for r in total):
        return whole, [named, members]
    long = members.where(~short)
    parts = long.groupBy("list", "root").agg(F.count(F.lit(1)).alias("own"), F.sum("n").alias("tokens"))
    parts = parts.withColumn("owner", F.when(F.col("own") > BLOCK_SETS // 2, F.col("root")).otherwise(-1))  # -1: blocks of many
    sizes = parts.groupBy("list", "owner").agg(F.greatest(F.ceil(F.sum("own") / BLOCK_SETS), F.ceil(F.sum("tokens") / BLOCK_TOKENS)).cast("int").alias("blocks"))
    parts = parts.select("list", "root", "owner").join(sizes, ["list", "owner"])
    block = F.xxhash64("list", "owner", "k")
    placed = long.join(parts, ["list", "root"]).withColumn("k", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int")).select("list", "cls", "doc_id", "th", block.alias("block"))
    blocks = sizes.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("list", "owner", block.alias("block"))
    x, y = blocks.alias("x"), blocks.alias("y")
    pairs = x.join(y, "list").where("x.block <= y.block AND (x.owner < 0 OR x.owner <> y.owner)")
    pairs = pairs.select("list", F.col("x.block").alias("i"), F.col("y.block").alias("j"), F.xxhash64("list", "x.block", "y.block").alias("task"))
    sides = pairs.select("list", "task", F.explode(F.when(F.col("i") == F.col("j"), F.array(F.struct(F.col("i").alias("block"), F.lit(2).alias("side")))).otherwise(F.array(F.struct(F.col("i").alias("block"), F.lit(0).alias("side")), F.struct(F.col("j").alias("block"), F.lit(1).alias("side"))))).alias("s")).select("list", "task", "s.block", "s.side")
    dealt = placed.join(sides, ["list", "block"]).select("cls", "doc_id", "th", "task", F.col("task").alias("list"), "side")
    return whole.union(dealt), [named, members]


def groups(docs: DataFrame, *, width: int, percent: int) -> DataFrame:
    """doc_id, th (hash of the text), n, component_id, and head_th: (component_id, head_th) is the component's first row."""
    docs = docs.select("doc_id", text_hash().alias("th"), "text")
    made = signatures(docs, common_tokens(docs, width), width=width, percent=percent)
    table = written(made.withColumn("rid", F.monotonically_increasing_id()))
    key = ["n", "s1", "s2"]
    classes = table.where("n > 0").groupBy(*key).agg(F.min(F.struct("doc_id", "th", "rid")).alias("head"))
    classes = written(classes.select(*key, F.col("head.rid").alias("cls"), "head.doc_id", "head.th"))
    firsts = table.join(classes.select(F.col("cls").alias("rid")), "rid").select(F.col("rid").alias("cls"), "n", "prefix")
    kept = written(second_prefix(firsts, percent))
    repeated = written(table.groupBy("doc_id", "th").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("doc_id", "th"))
    copies = repeated if repeated.limit(1).count() else None
    near = written(compared(docs, pivot_places(kept, classes), width=width, percent=percent, repeated=copies))
    places, read = open_places(kept, components(near), classes)
    roots = components(near.union(compared(docs, places, width=width, percent=percent, repeated=copies))).select(F.col("node").alias("cls"), "root")
    discard(kept, near, repeated, *read)
    named = written(classes.join(roots, "cls", "left").withColumn("root", F.coalesce("root", "cls")))
    least = named.groupBy("root").agg(F.min(F.struct("doc_id", "th")).alias("first"))
    named = named.join(least, "root").select(*key, F.col("first.doc_id").alias("component_id"), F.col("first.th").alias("head_th"))
    found = table.select("doc_id", "th", *key).join(named, key, "left")
    return found.select("doc_id", "th", "n", F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("head_th", "th").alias("head_th"))


def similar_groups(docs: DataFrame, *, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles and component_id of every document: the least doc_id reachable by links, itself included."""
    return groups(docs, width=width, percent=percent).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def one_of_each_group(docs: DataFrame, *, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs, with all columns, that are the first of their component by (doc_id, hash of the text).

    Rows that are repeated with doc_id and text are one; texts without words are in no group and stay."""
    found = written(groups(docs, width=width, percent=percent))
    repeated = found.groupBy("doc_id", "th").agg(F.count(F.lit(1)).alias("c")).where("c > 1").limit(1).count() > 0
    left = without(docs, found.where("doc_id <> component_id OR th <> head_th"))
    th = free_name(docs, "th")
    return left.withColumn(th, text_hash()).dropDuplicates(["doc_id", th]).drop(th) if repeated else left


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_groups(read_documents(spark, sf_dir), width=4, percent=85)


ORACLE_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i+3], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM w WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
m AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.component_id FROM documents d LEFT JOIN n USING (doc_id) JOIN m USING (doc_id)
"""
