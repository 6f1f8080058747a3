"""Mixing, conversation repair and resampling against brute force: nulls, empty and long texts, ties, repeated and hot rows."""

import collections
import hashlib
import heapq
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from framespan.llm import conversations, decontamination, jaccard, mixing, resampling, sharding

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# conversations


def damaged(rows):
    by = collections.defaultdict(list)
    text = lambda v: " " if v is None else str(v)
    for conv, turn, role, body in rows:
        kind = zlib.crc32(f"{text(conv)}:{text(turn)}".encode()) % 20
        found = by[conv]
        role, body = text(role), text(body)
        body = "" if kind == 1 else re.sub("[.!?]", "", body) if kind == 2 else body
        found += [(turn, "user" if kind == 4 else role, body)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return by


def cheapest_repair(rows):
    """Dijkstra over (cost, audit): faults, cost, audit and repaired turns."""
    rows = sorted(rows, key=lambda v: (v[0] is not None, v[0] or 0, v[1].encode(), v[2].encode()))
    seen, faults = set(), []
    for _, role, body in rows:
        letters = re.findall(r"[^\x20\x09-\x0D]", body)
        faults.append("blank" if not letters else "duplicate" if (role, body) in seen else "truncated" if letters[-1] not in ".!?" else "")
        seen.add((role, body))
    heap, done = [(0, "", 0, "", ())], set()
    follows, names = {"": "su", "s": "u", "u": "a", "a": "u"}, {"u": "user", "a": "assistant"}
    while True:
        cost, audit, k, state, out = heapq.heappop(heap)
        if (k, state) in done:
            continue
        done.add((k, state))
        if k == len(rows) and state in ("", "a"):
            break
        steps = [(2, "I", k, n, ((names[n], ""),)) for n in follows[state] if n in names]
        if k < len(rows):
            _, role, body = rows[k]
            steps.append((3, "D", k + 1, state, ()))
            if faults[k] in ("", "truncated"):
                more = faults[k] == "truncated"
                steps += [(more, "K", k + 1, n, ((role, body),)) for n in follows[state] if role[:1] == n]
                steps += [(2 + more, "R", k + 1, n, ((names[n], body),)) for n in follows[state] if n in names]
        for c, letter, at, n, made in steps:
            heapq.heappush(heap, (cost + c, audit + letter, at, n, out + made))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest), out


def talks():
    rnd = random.Random(12)
    bodies = ["Yes.", "No", " \n", "", None, "What? ", "é漢!", "long " * 3000 + ".", "a.b\x0b"]
    rows = []
    for conv in [*range(60), None]:
        for turn in range(rnd.choice([1, 2, 3, 6, 9])):
            rows.append((conv, rnd.choice([turn, turn, turn, turn - 1, None, turn * 3]), rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""]), rnd.choice(bodies) if turn % 3 else f"{turn} {conv}."))
    rows += [(7, k, ("user", "assistant")[k % 2], f"Turn {k}." if k % 5 else "Same text") for k in range(200)]  # a hot conversation
    rows += [(8, 1, "user", "Hot.")] * 150
    return rows + rows[:5]


TALKS = "conv_id long, turn long, role string, text string, repeated int, cid int, pos string"


@pytest.mark.parametrize("turns, block", [(4096, 4096), (20, 16), (3, 7)])
def test_conversation_repair(spark, monkeypatch, turns, block):
    monkeypatch.setattr(conversations, "LARGE_TURNS", turns)
    monkeypatch.setattr(conversations, "BLOCK", block)
    monkeypatch.setattr(conversations, "GATHER_TURNS", 100)
    rows = talks()
    table = spark.createDataFrame([(*r, 1, 2, "p") for r in rows], TALKS).repartition(5)
    expected = {conv: cheapest_repair(found) for conv, found in damaged(rows).items()}
    found = {r.conv_id: tuple(r)[1:] for r in conversations.repair(conversations.damage(table)).collect()}
    assert found == {conv: summary for conv, (summary, _) in expected.items()}
    lines = collections.defaultdict(list)
    for r in conversations.repaired_turns(conversations.damage(table)).orderBy("turn").collect():
        assert r.turn == len(lines[r.conv_id])
        lines[r.conv_id].append((r.role, r.text))
    assert {c: tuple(v) for c, v in lines.items() if v} == {c: out for c, (_, out) in expected.items() if out}


def test_conversation_tables_without_rows(spark):
    empty = spark.createDataFrame([], TALKS)
    assert conversations.repair(conversations.damage(empty)).count() == conversations.repaired_turns(empty).count() == 0
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    row = conversations.repair(conversations.damage(spark.createDataFrame([(gone, 0, "user", "x", 1, 1, "")], TALKS))).first()
    assert tuple(row) == (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_grammar_expands_to_its_sequences():
    rnd = random.Random(3)
    sequences = [tuple(rnd.choice([2, 4, 2, 4, 5, 8]) for _ in range(rnd.choice([0, 1, 2, 9, 300]))) for _ in range(40)] + [(2,) * 33]
    grammar = conversations.Grammar()
    short = grammar.compress(sequences)
    sides = {v: k for k, v in grammar.pairs.items()}

    def expand(s):
        return [s] if s <= conversations.REMOVED else expand(sides[s][0]) + expand(sides[s][1])

    assert [tuple(x for s in found for x in expand(s)) for found in short] == sequences
    pairs = collections.Counter(p for found in short for p in set(itertools.pairwise(found)))
    assert max(pairs.values()) == 1 and len(grammar.pairs) > 10
    direct = [[(0, None), None, None, None]]
    for s in sequences[-2]:
        direct = conversations.times(direct, grammar.matrix[s])
    by_rules = grammar.product(short[-2], [[(0, None), None, None, None]])
    assert [(e[0], str(e[1] or "")) if e else None for e in direct[0]] == [(e[0], str(e[1] or "")) if e else None for e in by_rules[0]]


def test_ropes_compare_as_text():
    rnd = random.Random(5)
    for _ in range(300):
        a, b = ("".join(rnd.choice("DK") for _ in range(rnd.randint(1, 9))) for _ in range(2))

        def rope(text):
            if len(text) == 1:
                return conversations.Rope(text)
            k = rnd.randint(1, len(text) - 1)
            return conversations.join(rope(text[:k]), rope(text[k:]))

        assert conversations.precedes(rope(a), rope(b)) == (a < b), (a, b)


# resampling


def expected_ranks(rows, target, most, percent=10, least=20, buckets=10_000):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def grams(text):
        w = word.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        return len(w), [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(1, most + 1) for i in range(len(w) - n + 1)]

    s, t = collections.Counter(), collections.Counter()
    for _, text in rows:
        s.update(grams(text)[1])
    for text in target:
        t.update(grams(text)[1])
    total, wanted = sum(s.values()), sum(t.values())
    out = []
    for doc_id, text in rows:
        n, found = grams(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (total + buckets) / ((s[b] + 1) * (wanted + buckets)))) for b in found)
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n])
    able = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    ranks = {id(r): k + 1 for k, r in enumerate(able[: percent * len(able) // 100])}
    return [(*r[:4], ranks.get(id(r))) for r in out]


@pytest.mark.parametrize("most, block", [(1, 1 << 18), (1, 7), (3, 50)])
def test_resampling(spark, monkeypatch, most, block):
    monkeypatch.setattr(resampling, "BLOCK", block)
    rnd = random.Random(most)
    vocabulary = ["the", "The", "x" * 40, "y" * 40, "straße", "漢字", "3d", "a_b", "end.", "naïve\x0bIX"] + [f"w{k}" for k in range(50)]
    rows = [(k, " ".join(rnd.choice(vocabulary) for _ in range(rnd.choice([0, 5, 19, 20, 21, 80])))) for k in range(150)]
    rows += [(150, None), (151, ""), (152, "--- ... "), (None, "the w1 " * 30), (153, "w2 the " * 20_000)]
    rows += [(154, "the w3 " * 15)] * 300  # a hot row
    target = ["the w1 w2 w3", None, "", "x" * 40]
    docs = spark.createDataFrame([(*r, 1, 1, 1) for r in rows], "doc_id long, text string, rank int, weight int, row int").repartition(4)
    wanted = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id long, text string")
    found = resampling.resample(docs, wanted, most=most).collect()
    key = lambda r: tuple((v is not None, v or 0) for v in r)
    assert sorted(map(tuple, found), key=key) == sorted(expected_ranks(rows, target, most), key=key)
    assert resampling.resample(docs.limit(0), wanted, most=most).count() == 0
    assert resampling.resample(docs, wanted.limit(0), most=most).count() == len(rows)


def test_slots_hash_as_xxhash64_and_verify_bytes():
    rnd = random.Random(9)
    found = [bytes(rnd.randrange(256) for _ in range(rnd.choice([0, 1, 3, 4, 5, 7, 8, 9, 15, 20, 31, 32, 33, 70]))) for _ in range(400)]
    found += found[:100]
    text = np.frombuffer(b"".join(found), np.uint8)
    end = np.cumsum([len(x) for x in found])
    start = end - [len(x) for x in found]
    short = np.array([len(x) < resampling.SHORT for x in found])
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    size = (end - start)[short]
    hashes = resampling.hash_lanes(resampling.lanes_of(padded, start[short], size), size)
    assert hashes.tolist() == [xxhash.xxh64_intdigest(x) for x in found if len(x) < resampling.SHORT]
    for key in (None, lambda h: h % np.uint64(3)):  # three keys for all: only the bytes tell features apart
        slots = resampling.Slots(text, start, end, key)
        by = collections.defaultdict(set)
        for x, s in zip(found, slots.slot, strict=True):
            by[x].add(s)
        assert all(len(s) == 1 for s in by.values()) and len(set().union(*by.values())) == len(by)
        assert {x: slots.count[min(s)] for x, s in by.items()} == collections.Counter(found)
        assert all(slots.bytes(slots.first[min(s)]) == x for x, s in by.items())


# mixing


def flow_cost(capacity, members, quota, times):
    """Brute force: most tokens, then least repetition cost, over all whole flows of small patterns."""
    best = None
    choices = [[c for c in itertools.product(range(times * cap + 1), repeat=len(m)) if sum(c) <= times * cap] for cap, m in zip(capacity, members, strict=True)]
    for flow in itertools.product(*choices):
        used = collections.Counter()
        for m, f in zip(members, flow, strict=True):
            for s, x in zip(m, f, strict=True):
                used[s] += x
        if all(used[s] <= q for s, q in enumerate(quota)):
            cost = sum(mixing.CONVEX(k // cap) for cap, f in zip(capacity, flow, strict=True) for k in range(sum(f)))
            key = (-sum(map(sum, flow)), cost)
            best = min(best, key) if best else key
    return best


def test_min_cost_flow_is_cheapest():
    rnd = random.Random(2)
    for _ in range(25):
        members = [[0], [0, 1], [1]][: rnd.randint(1, 3)]
        capacity = [rnd.randint(1, 3) for _ in members]
        quota = [rnd.randint(0, 7), rnd.randint(0, 7)]
        sent = mixing.min_cost_flow(capacity, members, quota, 3)
        totals = [sum(f.values()) for f in sent]
        assert all(sum(f.get(s, 0) for f in sent) <= q for s, q in enumerate(quota))
        cost = sum(mixing.CONVEX(k // cap) for cap, n in zip(capacity, totals, strict=True) for k in range(n))
        assert (-sum(totals), cost) == flow_cost(capacity, members, quota, 3)


def expected_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: 1 + k % 3 for k, s in enumerate(order)}
    closed = set()
    while True:
        rest = sum(sizes.values()) - sum(3 * sizes[s] for s in closed)
        share = rest / max(1, sum(weight[s] for s in order if s not in closed))
        more = {s for s in order if weight[s] * share > 3 * sizes[s]} - closed
        if not more:
            return {s: 3 * sizes[s] if s in closed else share * weight[s] for s in order}
        closed |= more


@pytest.mark.parametrize("ranges", [50_000, 3])
def test_mix_of_single_sources(spark, monkeypatch, ranges):
    monkeypatch.setattr(mixing, "RANGE_ROWS", ranges)
    monkeypatch.setattr(mixing, "RUN", 70)
    rnd = random.Random(11)
    rows = [(k, " ".join("w" * rnd.choice([1, 2, 5, 40, 90]) for _ in range(rnd.choice([0, 1, 4, 30, 200]))), rnd.choice(["a", "b", "é", "z", None])) for k in range(300)]
    rows += [(300, None, "a"), (None, "x y", "b"), (301, "tiny", "small"), (302, "", "none")]
    rows += [(303, "the hot row of all", "hot")] * 400 + [(304, "v " * 50_000, "b")]
    docs = spark.createDataFrame([(*r, 1, 1, 1) for r in rows], "doc_id long, text string, source string, pattern int, n int, size int").repartition(4)
    mixed, sources = mixing.mix(docs.withColumn("sources", F.array("source")))
    found = sorted(map(tuple, mixed.select("doc_id", "size", F.col("sources")[0], "taken").collect()), key=repr)
    assert collections.Counter(r[:3] for r in found) == collections.Counter((d, len(WORD.findall(t or "")), s) for d, t, s in rows)
    sizes, taken = collections.Counter(), collections.Counter()
    for _, size, source, words in found:
        sizes[source] += size
        taken[source] += words
        assert 0 <= words <= 3 * size
    wanted = expected_targets(sizes)
    assert {r.source: r.target for r in sources.collect()} == pytest.approx(wanted)
    for source, target in wanted.items():
        assert abs(taken[source] - target) <= 0.5, source
        levels = sorted(w / s for _, s, x, w in found if x == source and s)
        assert not levels or levels[-1] - levels[0] <= 1  # nothing is repeated before all is used
        assert sum(x != int(x) for x in levels) <= 1  # one document at most is cut
    again, _ = mixing.mix(docs.repartition(7, "text").withColumn("sources", F.array("source")))
    assert sorted(map(tuple, again.select("doc_id", "size", F.col("sources")[0], "taken").collect()), key=repr) == found
    assert mixing.mix(docs.limit(0).withColumn("sources", F.array("source")))[0].count() == 0


def test_mix_of_overlapping_sources(spark):
    rnd = random.Random(1)
    patterns = [["a"], ["a", "b"], ["b", "c"], ["c"], ["d"], [], ["b", "a", "a"], [None, "c"]]
    rows = [(k, "w " * rnd.randint(1, 30), rnd.choice(patterns)) for k in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sources array<string>").repartition(3)
    mixed, sources = mixing.mix(docs)
    number = {r.no: r for r in sources.collect()}
    taken, total = collections.Counter(), 0
    for r in mixed.collect():
        assert r.taken == sum(x.words for x in r.routes) <= 3 * r.size
        assert {number[x.no].source for x in r.routes} <= set(r.sources)
        for x in r.routes:
            taken[x.no] += x.words
    total = sum(r.target for r in number.values())
    assert sum(taken.values()) == pytest.approx(total, abs=len(number))
    for no, r in number.items():
        assert abs(taken[no] - r.target) <= 0.5, r


# hot rows and long documents of the earlier operators


def test_jaccard_copies_of_one_row(spark):
    """Thirty thousand copies of a row, near texts beside it, and copies of a near text: one component, one set each."""
    base = [f"w{k}" for k in range(80)]
    near = [" ".join([*base[:k], "new", *base[k + 1 :]]) for k in (0, 1, 78, 79)]
    rows = [(5, " ".join(base))] * 30_000 + [(10 + k, t) for k, t in enumerate(near)] + [(3, near[2])] * 200 + [(2, "other words of its own")] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    found = collections.Counter((r.doc_id, r.component_id) for r in jaccard.similar_groups(docs, width=4, percent=85).collect())
    assert found == {(5, 3): 30_000, **{(10 + k, 3): 1 for k in range(4)}, (3, 3): 200, (2, 2): 50}
    kept = sorted(tuple(r) for r in jaccard.one_of_each_group(docs, width=4, percent=85).collect())
    assert kept == [(2, "other words of its own"), (3, near[2])]


def test_a_document_that_holds_the_benchmark(spark, monkeypatch):
    rnd = random.Random(6)
    items = [" ".join(f"w{rnd.randrange(3000)}" for _ in range(rnd.choice([12, 30, 90]))) for _ in range(120)]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = spark.createDataFrame([(1, " ".join(items)), (2, " ".join(items[:3]) + " x" * 5000 + " " + items[50]), (3, "nothing of it " * 900), (4, " ".join(items[9].split()[4:] + ["end"] * 40))], "doc_id long, text string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plain = sorted(map(tuple, decontamination.flag_documents(docs, benchmark).collect()))
    monkeypatch.setattr(decontamination, "REGION", 10**9)
    assert sorted(map(tuple, decontamination.flag_documents(docs, benchmark).collect())) == plain
    monkeypatch.setattr(decontamination, "REGION", 100)
    assert sorted(map(tuple, decontamination.flag_documents(docs, benchmark).collect())) == plain
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert [r[2] for r in plain] == [120, 4, 0, 1]


def test_shards_are_skipped_by_least_and_greatest_value(spark):
    """A lookup opens hardly more shards, by their least and greatest values, than hold the value."""
    rnd = random.Random(8)
    rows = [(k, "w " * int(2 ** rnd.uniform(0, 12)), rnd.choice([f"src{s}" for s in range(20)]), rnd.choice(["de", "en", "es", "fr", None]), 1, 1) for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, value int, cell int").repartition(5)
    out = sharding.shard_documents(docs)
    named = out.join(docs.select("doc_id", "source", "lang"), "doc_id")
    edges = {r.shard: r for r in sharding.shard_manifest(named, ["source", "lang"]).collect()}
    held = collections.defaultdict(set)
    for r in named.collect():
        held["source", r.source].add(r.shard)
        held["lang", r.lang].add(r.shard)
    for dim in ("source", "lang"):
        values = [v for d, v in held if d == dim and v is not None]
        opened = sum(r[f"min_{dim}"] is not None and r[f"min_{dim}"] <= v <= r[f"max_{dim}"] for v in values for r in edges.values())
        need = sum(len(held[dim, v]) for v in values)
        assert need <= opened <= 1.15 * need < 0.6 * len(values) * len(edges), dim
