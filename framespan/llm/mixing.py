"""Mixing sources to target weights, by documents that may be in several sources.

Documents are added up by membership pattern, the set of sources they are in, and every source has a quota of tokens.  A
min-cost flow sends each pattern's tokens to its sources: a pattern has one arc a repetition, each as wide as its tokens,
and a later repetition costs more than an earlier one, so nothing is repeated before what is there once is used.  The flow
is solved apart for each group of sources that patterns link; what a task holds is that group's patterns, sums and no
documents.

Then documents are selected.  The items of a pattern (every copy of a document, once a repetition) stand in a line ordered
by a seeded digest; its flow covers whole lines and a part of the last.  The positions where the flow to one source ends
are found by sums over ranges of the digest and by order only inside the range that holds the position, so no task sees
a pattern's documents.  An item across such a position gives its first words to the source before and the rest to the next
one, or to none after the last, so every source gets its flow to the word.

Copies of one row (same doc_id, sources and size) are one row with a count from the start until the end, where they are
written out in runs.

Defined cases: null and empty texts have size 0 and are taken nowhere; a null source is a source of its own, last in order;
a document without sources (an empty list) is not taken; ties of the digest go to the smaller doc_id (null first) and size;
rows repeated in full are items of their own; very long texts count whole; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from framespan.llm._common import BROADCAST_ROWS, WORD, discard, ranked, read_documents, written
from framespan.llm._graph import components

MOST_TIMES = 3
WEIGHTS = (1, 2, 3)
SEED = 11
#: rows of a range of digests
RANGE_ROWS = 50_000
#: copies of one row that are written out at a time
RUN = 10_000
DIGITS = 15
#: cost of the first, second and further uses of a token: every one costs more than the one before
CONVEX = lambda k: k * (k + 1) // 2


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def min_cost_flow(capacity: list[int], members: list[list[int]], quota: list[int], times: int) -> list[dict[int, int]]:
    """Tokens that each pattern sends to each of its sources: as much as the quotas take, at the least cost of repetition.

    Successive shortest paths with potentials; nodes are the origin, patterns, sources and the end."""
    n, m = len(capacity), len(quota)
    origin, end = n + m, n + m + 1
    arcs: list[list[int]] = []  # to, left, cost; arc k ^ 1 is its reverse
    out: list[list[int]] = [[] for _ in range(n + m + 2)]

    def arc(a: int, b: int, width: int, cost: int) -> None:
        for x, y, w, c in ((a, b, width, cost), (b, a, 0, -cost)):
            out[x].append(len(arcs))
            arcs.append([y, w, c])

    for p in range(n):
        for k in range(times):
            arc(origin, p, capacity[p], CONVEX(k))
        for s in members[p]:
            arc(p, n + s, times * capacity[p], 0)
    for s in range(m):
        arc(n + s, end, quota[s], 0)
    potential = [0] * (n + m + 2)
    while True:
        reached: dict[int, int] = {}
        by: dict[int, int] = {}
        heap = [(0, origin, -1)]
        while heap:
            d, x, via = heapq.heappop(heap)
            if x in reached:
                continue
            reached[x], by[x] = d, via
            for k in out[x]:
                y, left, cost = arcs[k]
                if left > 0 and y not in reached:
                    heapq.heappush(heap, (d + cost + potential[x] - potential[y], y, k))
        if end not in reached:
            break
        far = reached[end]
        for x in range(len(potential)):
            potential[x] += min(reached.get(x, far), far)
        path, x = [], end
        while x != origin:
            path.append(by[x])
            x = arcs[by[x] ^ 1][0]
        width = min(arcs[k][1] for k in path)
        for k in path:
            arcs[k][1] -= width
            arcs[k ^ 1][1] += width
    return [{arcs[k][0] - n: arcs[k ^ 1][1] for k in out[p] if n <= arcs[k][0] < n + m and k % 2 == 0} for p in range(n)]


def targets(sources: DataFrame, total: int, *, most_times: int) -> DataFrame:
    """Adds target to sources (weight, source_size): shares of the total by weight, none above most_times its size.

    What is above is shared again by weight among the others, until none is above; a round is one sum over the sources."""
    cap = most_times * F.col("source_size")
    closed, rest, weight = 0, total, None
    share = None
    while True:
        stopped = F.lit(False) if share is None else F.col("weight") * share > cap
        sums = sources.agg(F.count_if(stopped).alias("n"), F.sum(F.when(stopped, cap)).alias("held"), F.sum(F.when(~stopped, F.col("weight"))).alias("w")).first()
        if share is not None and sums["n"] == closed:
            break
        closed, rest, weight = sums["n"], total - int(sums["held"] or 0), sums["w"]
        if not weight:
            return sources.withColumn("target", cap.cast("double"))
        share = F.lit(float(rest)) / F.lit(int(weight))
    return sources.withColumn("target", F.when(stopped, cap.cast("double")).otherwise(F.lit(float(rest)) * F.col("weight") / F.lit(int(weight))))


def flows(patterns: DataFrame, sources: DataFrame, *, most_times: int) -> DataFrame:
    """pattern, no, tokens: what each pattern (pattern, nos, capacity) sends to each source (no, target)."""
    links = patterns.where(F.size("nos") > 1).select(F.col("nos")[0].alias("a"), F.explode("nos").alias("b"))
    first = patterns.select("pattern", "nos", "capacity", F.col("nos")[0].alias("node"))
    if links.limit(1).count():
        first = first.join(components(links), "node", "left").withColumn("part", F.coalesce("root", "node"))
    else:
        first = first.withColumn("part", F.col("node"))
    rows = first.select("part", "pattern", "capacity", F.explode("nos").alias("no")).join(sources.select("no", "target"), "no")

    def solve(group: pd.DataFrame) -> pd.DataFrame:
        capacity = group.drop_duplicates("pattern").sort_values("pattern")
        quota = group.drop_duplicates("no").sort_values("no")
        place = {no: k for k, no in enumerate(quota["no"])}
        members = group.groupby("pattern")["no"].apply(lambda nos: sorted(place[no] for no in nos))
        ids = capacity["pattern"].tolist()
        sent = min_cost_flow(capacity["capacity"].tolist(), [members[p] for p in ids], [int(t + 0.5) for t in quota["target"]], most_times)
        nos = quota["no"].tolist()
        return pd.DataFrame([(p, nos[s], tokens) for p, found in zip(ids, sent, strict=True) for s, tokens in sorted(found.items()) if tokens], columns=["pattern", "no", "tokens"]).astype("int64")

    return rows.groupBy("part").applyInPandas(solve, "pattern long, no long, tokens long")


def cut_points(items: DataFrame, cuts: DataFrame, ranges: int, small: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """pattern, cut and first of cuts (pattern, cut, pos): h, at and copy of the first item that ends behind pos, and before,
    the words of the items ahead of it.  And the table that this reads."""
    width = -(-(16**DIGITS) // ranges)
    items = items.withColumn("range", F.expr(f"h div {width}"))
    sums = items.groupBy("pattern", "range").agg(F.sum(F.col("size") * F.col("n")).alias("words"))
    line = Window.partitionBy("pattern").orderBy("range")  # one row a range
    sums = sums.withColumn("start", F.sum("words").over(line) - F.col("words"))
    holding = written(sums.join(small(cuts), "pattern").where("pos >= start AND pos < start + words"))
    inside = items.join(small(holding.select("pattern", "range").distinct()), ["pattern", "range"])
    order = Window.partitionBy("pattern", "range").orderBy("h", "doc_id", "size")
    inside = inside.where("size > 0").withColumn("own", F.sum(F.col("size") * F.col("n")).over(order) - F.col("size") * F.col("n"))
    found = inside.join(small(holding), ["pattern", "range"]).where(F.col("start") + F.col("own") + F.col("size") * F.col("n") > F.col("pos"))
    copies = F.expr("(pos - start - own) div size")
    first = found.groupBy("pattern", "cut").agg(F.min(F.struct("h", F.struct("doc_id", "size").alias("at"), F.greatest(copies, F.lit(0)).alias("copy"), (F.col("start") + F.col("own") + F.greatest(copies, F.lit(0)) * F.col("size")).alias("before"))).alias("first"))
    return first, holding


def mix(docs: DataFrame, *, sources: str = "sources", weights: tuple[int, ...] = WEIGHTS, most_times: int = MOST_TIMES, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """doc_id, size, sources, routes (no of a source, words for it) and taken of every document of docs (doc_id, text, list
    of sources); and the sources: source, no, weight, source_size and target.

    Sources in the order of their text weigh `weights`, repeating; targets share the number of all words."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("long")
    rows = docs.select("doc_id", F.array_sort(F.array_distinct(F.coalesce(F.col(sources), F.array().cast("array<string>")))).alias("sources"), word_count(F.col("text")).alias("size"))
    rows = written(rows.groupBy("doc_id", "sources", "size").agg(F.count(F.lit(1)).alias("n")))
    words = F.sum(F.col("size") * F.col("n"))
    sums = written(rows.groupBy("sources").agg(words.alias("capacity"), F.count(F.lit(1)).alias("rows")))
    whole = sums.agg(F.sum("capacity").alias("words"), F.sum("rows").alias("rows"), F.sum(F.size("sources")).alias("cuts")).first()
    small = F.broadcast if (whole["cuts"] or 0) <= BROADCAST_ROWS else lambda table: table
    named = sums.select(F.explode("sources").alias("source"), "capacity").groupBy("source").agg(F.sum("capacity").alias("source_size"))
    named = ranked(named, F.asc_nulls_last("source"), name="no").withColumn("no", F.col("no").cast("long"))
    cycle = F.array(*map(F.lit, weights))
    listed = written(named.withColumn("weight", F.element_at(cycle, F.pmod(F.col("no") - 1, F.lit(len(weights))).cast("int") + 1)))
    sized = written(targets(listed, int(whole["words"] or 0), most_times=most_times))
    coded = sums.select("sources", "capacity", F.monotonically_increasing_id().alias("pattern"), F.explode("sources").alias("source"))
    coded = coded.join(small(sized.select(F.col("source").alias("named"), "no")), F.col("source").eqNullSafe(F.col("named")))
    patterns = written(coded.groupBy("pattern", "sources", "capacity").agg(F.array_sort(F.collect_list("no")).alias("nos")))
    sent = written(flows(patterns, sized, most_times=most_times))

    # every flow ends at a cut: so many whole lines and a position in the next
    line = Window.partitionBy("pattern").orderBy("no")  # one row a source of the pattern
    cuts = sent.join(patterns.select("pattern", "capacity"), "pattern").withColumn("end", F.sum("tokens").over(line))
    cuts = cuts.selectExpr("pattern", "no", "no AS cut", "end div capacity AS lines", "end % capacity AS pos")
    items = rows.join(small(patterns.select(F.col("sources").alias("of"), "pattern")), F.expr("sources <=> of")).drop("of").withColumn("h", h)
    ranges = 1 << ((whole["rows"] or 0) // RANGE_ROWS).bit_length()
    at, holding = cut_points(items, cuts.where("pos > 0"), ranges, small)
    cuts = cuts.join(at, ["pattern", "cut"], "left")
    part = F.col("pos") - F.col("first.before")
    plan = cuts.groupBy("pattern").agg(F.array_sort(F.collect_list(F.struct("no", "lines", F.struct("first.h", "first.at", "first.copy").alias("item"), part.alias("part")))).alias("cuts"))
    plan = written(plan)
    discard(sums, listed, sent, holding)

    runs = items.join(small(plan), "pattern", "left").withColumn("run", F.explode(F.sequence(F.lit(0), F.expr(f"(n - 1) div {RUN}"))))
    if rows.where(F.col("n") > RUN).limit(1).count():
        runs = runs.repartition("pattern", "doc_id", "size", "run")
    each = runs.withColumn("copy", F.explode(F.sequence(F.col("run") * RUN, F.least(F.col("n"), (F.col("run") + 1) * RUN) - 1)))
    me = F.struct(F.col("h"), F.struct("doc_id", "size").alias("at"), F.col("copy").cast("long").alias("copy"))
    # words of this item before each cut; those of a source are the difference of neighbours
    begun = lambda c: F.when(c["part"].isNull() | (me > c["item"]), 0).when(me == c["item"], c["part"]).otherwise(F.col("size"))
    routed = each.withColumn("before", F.transform("cuts", lambda c: c["lines"] * F.col("size") + begun(c)))
    words = F.transform("cuts", lambda c, k: F.struct(c["no"].alias("no"), (F.col("before")[k] - F.when(k > 0, F.col("before")[k - 1]).otherwise(0)).alias("words")))
    routes = F.coalesce(F.filter(words, lambda r: r["words"] > 0), F.array().cast("array<struct<no:bigint,words:bigint>>"))
    out = routed.select("doc_id", "size", "sources", routes.alias("routes"), F.coalesce(F.element_at("before", -1), F.lit(0)).cast("long").alias("taken"))
    lost = rows.where(F.size("sources") == 0).select("doc_id", "size", "sources", F.array().cast("array<struct<no:bigint,words:bigint>>").alias("routes"), F.lit(0).cast("long").alias("taken"), F.explode(F.sequence(F.lit(1), F.col("n")))).drop("col")
    return out.unionByName(lost), sized


def op11_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir).select("doc_id", "text", F.array("source").alias("sources"))
    mixed, sized = mix(docs)
    sized = sized.select(F.col("source").alias("named"), "source_size", "target")
    sized = F.broadcast(sized) if sized.count() <= BROADCAST_ROWS else sized
    joined = mixed.withColumn("source", F.col("sources")[0]).join(sized, F.col("source").eqNullSafe(F.col("named")))
    return joined.select("doc_id", "size", "source_size", "target", "taken")


ORACLE_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         CAST('0x' || substr(sha256('11:' || coalesce(doc_id::VARCHAR, '')), 1, 15) AS BIGINT) AS h FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT AS w FROM d GROUP BY source
), shared AS (
  SELECT 0 AS k, -1::BIGINT AS closed, sum(source_size)::BIGINT AS rest, sum(w)::BIGINT AS weight FROM s
  UNION ALL
  SELECT k + 1, closed, rest, weight FROM (
    SELECT k, shared.closed AS was, count(*) FILTER (WHERE w * (rest::DOUBLE / weight) > 3 * source_size) AS closed,
           (sum(source_size) - coalesce(sum(3 * source_size) FILTER (WHERE w * (rest::DOUBLE / weight) > 3 * source_size), 0))::BIGINT AS rest,
           (sum(w) FILTER (WHERE w * (rest::DOUBLE / weight) <= 3 * source_size))::BIGINT AS weight
    FROM shared CROSS JOIN s GROUP BY k, shared.closed
  ) WHERE closed <> was
), t AS (
  SELECT source, source_size, CASE WHEN w * (rest::DOUBLE / weight) > 3 * source_size THEN (3 * source_size)::DOUBLE ELSE rest::DOUBLE * w / weight END AS target
  FROM s, (SELECT rest, weight FROM shared ORDER BY k DESC LIMIT 1)
), line AS (
  SELECT d.*, source_size, target, CASE WHEN source_size = 0 THEN 0 ELSE floor(target + 0.5)::BIGINT // source_size END AS lines,
         CASE WHEN source_size = 0 THEN 0 ELSE floor(target + 0.5)::BIGINT % source_size END AS pos, sum(size) OVER (o ROWS UNBOUNDED PRECEDING) AS ends
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source WINDOW o AS (PARTITION BY d.source ORDER BY h, doc_id NULLS FIRST, size)
)
SELECT doc_id, size, source_size, target, (size * lines + greatest(0, least(size, pos - (ends - size))))::BIGINT AS taken FROM line
"""
