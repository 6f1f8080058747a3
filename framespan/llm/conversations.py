"""Repair of the turn structure of conversations by the cheapest edits.

A conversation should be empty, or an optional system turn and then pairs of a user and an assistant turn.  Turns may be
blank, repeated or cut off, or have the wrong role.  Edits are Keep (0), Rerole to user or assistant (2), Delete (3, the
only one for blank and repeated turns) and Insert of an empty user or assistant turn (2); a cut-off turn that stays adds 1.

Every turn is a symbol of role and fault.  The symbols of many conversations are compressed by Re-Pair: the most frequent
pair becomes a rule until no pair occurs twice.  A symbol has one min-plus transfer matrix over the four states of the
grammar, whose entries are a cost and an audit, a rope of edit letters that shares its parts with the rules below; a rule's
matrix is the product of its two sides, made once, when they exist, and used by all conversations of the task.  Ropes are
compared by hash down to the first difference, so equal costs give the least audit.

Conversations are dealt by conv_id and read as sorted streams.  Those of more than LARGE_TURNS turns or LARGE_BYTES bytes
are counted first and cut into blocks by ranks: each block is one matrix in a task of its own, the blocks' matrices are
multiplied in order, and the last pass reads the turns of one conversation as a stream with its audit (SHA-256 can only be
taken in order); repeated turns are found by a join on the digest.

Defined cases: null roles and texts are one space; null turns come first and are no turn in the gaps; turns with one number
are ordered by role and text; turns repeated in full are repeated turns; a role that begins with none of s, u, a is kept
nowhere; null conv_ids are one conversation; very long texts are whole; a conversation without turns has zeros, an empty
audit and the digest of nothing; an empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framespan.llm._common import BLANKS, BROADCAST_ROWS, discard, ranked, read_table, written

#: states: nothing yet, after the system turn, after a user turn, after an assistant turn
START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {"s": 0, "u": 1, "a": 2}
OTHER, REMOVED = 3, 8
LARGE_TURNS = 4096
LARGE_BYTES = 16 << 20
#: turns in a block of a large conversation
BLOCK = 4096
#: turns and bytes of texts that a task gathers for one grammar
GATHER_TURNS, GATHER_BYTES = 8192, 16 << 20
#: rules of a task before it starts anew
RULES = 50_000
PRIME, BASE = (1 << 61) - 1, 1_000_003
FINE, BLANK, CUT_OFF = 0, 1, 2
SUMMARY = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


class Rope:
    """Text as a tree that shares parts; hash and size decide equality."""

    __slots__ = ("hash", "left", "letter", "right", "shift", "size")

    def __init__(self, letter: str = "", left: Rope | None = None, right: Rope | None = None):
        self.letter, self.left, self.right = letter, left, right
        if left is None:
            self.size, self.hash, self.shift = 1, ord(letter), BASE
        else:
            self.size, self.shift = left.size + right.size, left.shift * right.shift % PRIME
            self.hash = (left.hash * right.shift + right.hash) % PRIME

    def __str__(self) -> str:
        letters, todo = [], [self]
        while todo:
            x = todo.pop()
            if x.left is None:
                letters.append(x.letter)
            else:
                todo += [x.right, x.left]
        return "".join(letters)


def join(a: Rope | None, b: Rope | None) -> Rope | None:
    return b if a is None else a if b is None else Rope("", a, b)


def precedes(a: Rope | None, b: Rope | None) -> bool:
    """Whether a is the lesser text; parts that are equal are passed by their hash."""
    x, y = [a] if a else [], [b] if b else []
    while x and y:
        p, q = x.pop(), y.pop()
        if p is q or (p.size == q.size and p.hash == q.hash):
            continue
        if p.left is None and q.left is None:
            return p.letter < q.letter
        if p.size >= q.size and p.left is not None:
            x += [p.right, p.left]
            y.append(q)
        else:
            y += [q.right, q.left]
            x.append(p)
    return not x and bool(y)


Entry = tuple[int, Rope | None]
Matrix = list[list[Entry | None]]


def times(a: Matrix, b: Matrix) -> Matrix:
    """The min-plus product: the least (cost, audit) over all states between."""
    out = []
    for row in a:
        made = []
        for q in range(4):
            best = None
            for k, first in enumerate(row):
                second = b[k][q]
                if first is not None and second is not None:
                    cost = first[0] + second[0]
                    if best is None or cost <= best[0]:
                        audit = join(first[1], second[1])
                        if best is None or cost < best[0] or precedes(audit, best[1]):
                            best = cost, audit
            made.append(best)
        out.append(made)
    return out


_INSERT, _KEEP, _REROLE, _DELETE = Rope("I"), Rope("K"), Rope("R"), Rope("D")


def _blank_matrix() -> Matrix:
    return [[None] * 4 for _ in range(4)]


def inserted() -> Matrix:
    """What Inserts alone can do: a user turn but after a user turn, where an assistant turn follows."""
    one, none = _blank_matrix(), _blank_matrix()
    for p in range(4):
        none[p][p] = one[p][p] = (0, None)
    for p in (START, SYSTEM, ASSISTANT):
        one[p][USER] = (2, _INSERT)
    one[USER][ASSISTANT] = (2, _INSERT)
    return times(one, one)  # a third Insert in a row only comes back


INSERTED = inserted()


def turn_matrix(symbol: int) -> Matrix:
    """Inserts before a turn and the edit of the turn itself."""
    edit = _blank_matrix()
    for p in range(4):
        edit[p][p] = (3, _DELETE)
    if symbol != REMOVED:
        role, extra = symbol // 2, symbol % 2
        for p, q in ((START, USER), (SYSTEM, USER), (ASSISTANT, USER), (USER, ASSISTANT)):
            edit[p][q] = (extra, _KEEP) if role == q - 1 else (2 + extra, _REROLE)
        if role == ROLES["s"]:
            edit[START][SYSTEM] = (extra, _KEEP)
    return times(INSERTED, edit)


class Grammar:
    """Rules of pairs and their matrices; symbols 0 to REMOVED are turns."""

    def __init__(self) -> None:
        self.pairs: dict[tuple[int, int], int] = {}
        self.matrix = [turn_matrix(s) for s in range(REMOVED + 1)]

    def rule(self, left: int, right: int) -> int:
        if (left, right) not in self.pairs:
            self.pairs[left, right] = len(self.matrix)
            self.matrix.append(times(self.matrix[left], self.matrix[right]))
        return self.pairs[left, right]

    def compress(self, sequences: list[tuple[int, ...]]) -> list[list[int]]:
        """Re-Pair: the most frequent pair is replaced by a rule until none occurs twice."""
        x = np.concatenate([np.append(np.array(s, np.int64), -1) for s in sequences]) if sequences else np.zeros(0, np.int64)
        passed: set[int] = set()
        while len(x) > 1:
            code = np.where((x[:-1] >= 0) & (x[1:] >= 0), x[:-1] << 32 | x[1:], -1)
            values, counts = np.unique(code[code >= 0], return_counts=True)
            if passed:
                counts[np.isin(values, list(passed))] = 0
            if not len(counts) or counts.max() < 2:
                break
            best = int(values[counts.argmax()])
            left, right = best >> 32, best & 0xFFFFFFFF
            at = np.flatnonzero(code == best)
            if left == right:  # of a run every other pair
                first = np.concatenate([[True], np.diff(at) > 1])
                at = at[(at - at[np.flatnonzero(first)[np.cumsum(first) - 1]]) % 2 == 0]
            if len(at) < 2:
                passed.add(best)
                continue
            x[at] = self.rule(left, right)
            x = np.delete(x, at + 1)
        ends = np.flatnonzero(x < 0)
        return [part[part >= 0].tolist() for part in np.split(x, ends[:-1] + 1)] if len(ends) else []

    def product(self, symbols: list[int], rows: Matrix) -> Matrix:
        for s in symbols:
            rows = times(rows, self.matrix[s])
        return rows


def cheapest(row: list[Entry | None]) -> Entry:
    """The least entry of a row of states in which a conversation may end."""
    done = times([row], INSERTED)[0]
    found = [e for e in (done[START], done[ASSISTANT]) if e]
    return min(found, key=lambda e: (e[0], str(e[1] or "")))


def damage(turns: DataFrame) -> DataFrame:
    """Faults planted by checksums of conv_id and turn: dropped, emptied, cut off, repeated, made a user's.

    conv_id, turn, role, text and copies: 0 of a dropped turn, 2 of a repeated one."""
    value = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(value("conv_id"), F.lit(":"), value("turn")).cast("binary")), F.lit(20))
    text = F.when(kind == 1, "").when(kind == 2, F.translate(value("text"), ".!?", "")).otherwise(value("text"))
    return turns.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(value("role")).alias("role"), text.alias("text"), F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


def prepared(turns: DataFrame) -> DataFrame:
    """The columns the passes read; without a column copies every turn is there once."""
    value = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    last = F.substring(F.rtrim(F.col("text"), F.lit(BLANKS)), -1, 1)
    fault = F.when(last == "", BLANK).when(last.isin(".", "!", "?"), FINE).otherwise(CUT_OFF)
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), value("role").alias("role"), value("text").alias("text"), (F.col("copies") if "copies" in turns.columns else F.lit(1)).cast("int").alias("copies"))
    rows = rows.withColumn("fault", F.when(F.col("copies") > 0, fault))
    return rows.withColumn("text", F.when(F.col("copies") > 0, F.col("text"))).withColumn("role", F.when(F.col("copies") > 0, F.col("role")))


#: ascending, nulls first
ORDER = ["turn", "role", "text"]


def symbol_of(role: str, fault: int, repeated: bool) -> int:
    return REMOVED if fault == BLANK or repeated else 2 * ROLES.get(role[:1], OTHER) + (fault == CUT_OFF)


def legal(a: str, b: str) -> bool:
    return (a, b) in (("s", "u"), ("u", "a"), ("a", "u"))


def after(audit: str, state: int, turns: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str] | int]:
    """The repaired (role, text) of an audit that begins in a state; the last thing given is the state it ends in."""
    for edit in audit:
        made = ("assistant" if state == USER else "user"), ""
        if edit != "I":
            role, text = next(turns)
            made = (role, text) if edit == "K" else (made[0], text)
        if edit != "D":
            state = 1 + ROLES[made[0][0]]
            yield made
    yield state


class Conversation:
    """A conversation that a task has gathered: turn numbers and, of what is left after damage, role, text and fault."""

    def __init__(self, conv_id) -> None:
        self.conv_id, self.numbers, self.rows = conv_id, [], []

    def measured(self) -> tuple[tuple[int, ...], list[int]]:
        """Its symbols; gaps, blank, duplicate, truncated and illegal."""
        seen, symbols, counts = set(), [], [0, 0, 0, 0]
        before = None
        for role, text, fault in self.rows:
            repeated = (role, text) in seen
            seen.add((role, text))
            symbols.append(symbol_of(role, fault, repeated))
            counts[0] += fault == BLANK
            counts[1] += fault != BLANK and repeated
            counts[2] += fault == CUT_OFF and not repeated
            counts[3] += before is not None and not legal(before, role[:1])
            before = role[:1]
        known = [n for n in self.numbers if n is not None]
        return tuple(symbols), [max(known) - min(known) + 1 - len(set(known)) if known else 0, *counts]


def conversations(it: Iterator[pa.RecordBatch]) -> Iterator[list[Conversation]]:
    """Conversations of a sorted stream, many at a time."""
    gathered: list[Conversation] = []
    turns = size = 0
    for batch in it:
        for conv_id, turn, role, text, copies, fault in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "copies", "fault")), strict=True):
            if not gathered or gathered[-1].conv_id != conv_id:
                if turns >= GATHER_TURNS or size >= GATHER_BYTES:
                    yield gathered
                    gathered, turns, size = [], 0, 0
                gathered.append(Conversation(conv_id))
            if copies:
                gathered[-1].numbers.append(turn)
                gathered[-1].rows += [(role, text, fault)] * copies
                turns += copies
                size += len(text)
    if gathered:
        yield gathered


def repaired(it: Iterator[pa.RecordBatch]) -> Iterator[tuple[Conversation, list[int], Entry, list[tuple[str, str]]]]:
    """Each conversation of the stream with its counts, cheapest edits and repaired turns."""
    grammar = Grammar()
    for found in conversations(it):
        if len(grammar.matrix) > RULES:
            grammar = Grammar()
        measured = [c.measured() for c in found]
        known = {symbols: None for symbols, _ in measured}
        identity = [(0, None), None, None, None]
        for symbols, short in zip(known, grammar.compress(list(known)), strict=True):
            cost, audit = cheapest(grammar.product(short, [identity])[0])
            known[symbols] = cost, str(audit or "")
        for c, (symbols, counts) in zip(found, measured, strict=True):
            cost, audit = known[symbols]
            yield c, counts, (cost, audit), list(after(audit, START, ((role, text) for role, text, _ in c.rows)))[:-1]


def large_conversations(rows: DataFrame) -> DataFrame | None:
    """conv_id and cid of conversations with too many turns or bytes for one list; None where there are none."""
    sizes = rows.groupBy("conv_id").agg(F.sum("copies").alias("turns"), F.sum(F.octet_length("text") * F.col("copies")).alias("bytes"))
    found = written(sizes.where((F.col("turns") > LARGE_TURNS) | (F.col("bytes") > LARGE_BYTES)).select("conv_id", F.monotonically_increasing_id().alias("cid")))
    if found.limit(1).count():
        return found
    discard(found)
    return None


def _matched(rows: DataFrame, large: DataFrame, how: str) -> DataFrame:
    few = large.count() <= BROADCAST_ROWS
    named = large.withColumnRenamed("conv_id", "large_id")
    return rows.join(F.broadcast(named) if few else named, F.col("conv_id").eqNullSafe(F.col("large_id")), how)


class Large:
    """The pass over conversations that no task may gather: blocks, their matrices, and the audits in order."""

    def __init__(self, rows: DataFrame, large: DataFrame):
        self.large = large
        items = _matched(rows, large, "inner").select("cid", "turn", "role", "text", "fault", F.explode(F.sequence(F.lit(1), F.greatest("copies", F.lit(1)))).alias("copy"), "copies").where("copies > 0")
        items = items.withColumn("salt", F.monotonically_increasing_id())
        keys = ["cid", *ORDER, "salt", "copy"]
        self.placed = written(ranked(items.select("cid", "turn", "role", "text", "fault", "salt", "copy"), *keys, name="pos").select("cid", "turn", "role", "text", "fault", "pos", F.sha2(F.concat_ws("\0", "role", "text"), 256).alias("digest")))
        again = self.placed.groupBy("cid", "digest").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
        marked = self.placed.select("cid", "turn", F.substring("role", 1, 1).alias("initial"), "fault", "pos", "digest").join(again, ["cid", "digest"], "left")
        marked = marked.withColumn("repeated", F.coalesce(F.col("pos") > F.col("first"), F.lit(False)))
        self.marked = written(marked.select("cid", "turn", "initial", "fault", "pos", "repeated", F.expr(f"pos div {BLOCK}").alias("block")))

    def counts(self) -> DataFrame:
        turns = self.marked.groupBy("cid", "turn").agg(F.count(F.lit(1)).alias("rows")).groupBy("cid").agg((F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps"))
        is_blank = F.col("fault") == BLANK
        return self.marked.groupBy("cid").agg(
            F.count_if(is_blank).alias("blank"), F.count_if(~is_blank & F.col("repeated")).alias("duplicate"), F.count_if((F.col("fault") == CUT_OFF) & ~F.col("repeated")).alias("truncated")
        ).join(turns, "cid").withColumn("gaps", F.coalesce("gaps", F.lit(0)))

    def audits(self) -> DataFrame:
        """cid, block, the block's audit and entry state, the conversation's cost and illegal neighbours on every row."""

        def matrix(group: pd.DataFrame) -> pd.DataFrame:
            group = group.sort_values("pos")
            symbols = tuple(symbol_of(i or "", f, r) for i, f, r in zip(group["initial"], group["fault"], group["repeated"], strict=True))
            grammar = Grammar()
            rows = grammar.product(grammar.compress([symbols])[0], [[(0, None) if p == q else None for q in range(4)] for p in range(4)])
            initials = group["initial"].tolist()
            illegal = sum(not legal(a, b) for a, b in zip(initials, initials[1:], strict=False))
            entries = [{"p": p, "q": q, "cost": e[0], "audit": str(e[1] or "")} for p, row in enumerate(rows) for q, e in enumerate(row) if e]
            return pd.DataFrame({"cid": [group["cid"].iloc[0]], "block": [group["block"].iloc[0]], "head": [initials[0]], "tail": [initials[-1]], "illegal": [illegal], "entries": [entries]})

        def chosen(group: pd.DataFrame) -> pd.DataFrame:
            group = group.sort_values("block")
            best: list[tuple[int, str, list] | None] = [(0, "", []), None, None, None]
            illegal, tail = 0, None
            for head, end, inside, entries in zip(group["head"], group["tail"], group["illegal"], group["entries"], strict=True):
                illegal += inside + (tail is not None and not legal(tail, head))
                tail, made = end, [None] * 4
                for e in entries:
                    before = best[e["p"]]
                    if before is not None:
                        found = before[0] + e["cost"], before[1] + e["audit"], (before[2], e["p"], e["audit"])
                        if made[e["q"]] is None or found[:2] < made[e["q"]][:2]:
                            made[e["q"]] = found
                best = made
            ends = []
            for p, found in enumerate(best):
                for q in (START, ASSISTANT):
                    step = INSERTED[p][q]
                    if found is not None and step is not None:
                        ends.append((found[0] + step[0], found[1] + str(step[1] or ""), found[2], str(step[1] or "")))
            cost, _, path, closing = min(ends, key=lambda e: e[:2])
            states, audits = [], []
            while path:
                path, p, audit = path
                states.append(p)
                audits.append(audit)
            audits[0] += closing
            return pd.DataFrame({"cid": group["cid"], "block": group["block"], "state": states[::-1], "edits": audits[::-1], "cost": cost, "illegal": illegal})

        blocks = self.marked.groupBy("cid", "block").applyInPandas(matrix, "cid long, block long, head string, tail string, illegal long, entries array<struct<p:int,q:int,cost:long,audit:string>>")
        return written(blocks.groupBy("cid").applyInPandas(chosen, "cid long, block long, state int, edits string, cost long, illegal long"))

    def stream(self, audits: DataFrame) -> DataFrame:
        """The turns in order; the first of a block carries the block's audit."""
        first = self.placed.groupBy("cid", F.expr(f"pos div {BLOCK}").alias("block")).agg(F.min("pos").alias("pos")).join(audits, ["cid", "block"]).drop("block")
        return self.placed.select("cid", "pos", "role", "text").join(first, ["cid", "pos"], "left").repartition("cid").sortWithinPartitions("cid", "pos")


def followed(it: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, str, Iterator[tuple[str, str]]]]:
    """cid, edits and repaired turns of each block of a stream, in order."""

    def rows() -> Iterator[tuple]:
        for batch in it:
            yield from zip(*(batch.column(c).to_pylist() for c in ("cid", "role", "text", "edits", "state", "cost", "illegal")), strict=True)

    held = None
    source = rows()
    while (head := held or next(source, None)) is not None:
        held = None
        cid, role, text, edits, state, cost, illegal = head

        def turns(role=role, text=text) -> Iterator[tuple[str, str]]:
            yield role, text
            for row in source:
                yield row[1], row[2]

        yield cid, edits, cost, illegal, (made for made in after(edits, state, turns()) if not isinstance(made, int))


def repair(turns: DataFrame) -> DataFrame:
    """One row a conversation: faults counted, cost, audit and the digest of the repaired `role:text` lines.

    turns: conv_id, turn, role, text and perhaps copies, how many times a turn is there (0: its conv_id alone counts)."""
    rows = prepared(turns)
    large = large_conversations(rows)
    kind = rows.schema["conv_id"].dataType.simpleString()

    def summaries(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[tuple] = []
        schema = None
        for batch in (b for b in it if b.num_rows):
            schema = batch.schema.field("conv_id").type
            made += [(c.conv_id, *counts, *edits, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest()) for c, counts, edits, fixed in repaired(_again(batch, it))]
        if made:
            columns = list(zip(*made, strict=True))
            types = [schema, *[pa.int64()] * 6, pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, types, strict=True)], names=["conv_id", *(c.split()[0] for c in SUMMARY.split(", "))])

    small = rows if large is None else _matched(rows, large, "left_anti")
    found = small.repartition("conv_id").sortWithinPartitions("conv_id", *ORDER).mapInArrow(summaries, f"conv_id {kind}, {SUMMARY}")
    if large is None:
        return found
    work = Large(rows, large)

    def digests(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest, audit, numbers, any_turn = None, None, [], (0, 0), False
        names = ["cid", "cost", "illegal", "audit", "repaired_sha256"]

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([dict(zip(names, (current, *numbers, "".join(audit), digest.hexdigest()), strict=True))], pa.schema(list(zip(names, [pa.int64()] * 3 + [pa.string()] * 2, strict=True))))

        for cid, edits, cost, illegal, fixed in followed(it):
            if cid != current:
                if current is not None:
                    yield done()
                current, digest, audit, numbers, any_turn = cid, hashlib.sha256(), [], (cost, illegal), False
            audit.append(edits)
            for role, text in fixed:
                digest.update(f"{chr(10) * any_turn}{role}:{text}".encode())
                any_turn = True
        if current is not None:
            yield done()

    audits = work.audits()
    ended = work.stream(audits).mapInArrow(digests, "cid long, cost long, illegal long, audit string, repaired_sha256 string")
    ended = large.join(work.counts().join(ended, "cid"), "cid")
    return found.unionByName(ended.select(found.columns))


def _again(first: pa.RecordBatch, rest: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield first
    yield from rest


def repaired_turns(turns: DataFrame) -> DataFrame:
    """conv_id, turn (from 0), role and text of the repaired conversations."""
    rows = prepared(turns)
    large = large_conversations(rows)
    kind = rows.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "turn", "role", "text"]

    def lines(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b for b in it if b.num_rows):
            types = pa.schema(list(zip(names, [batch.schema.field("conv_id").type, pa.int64(), pa.string(), pa.string()], strict=True)))
            for c, _, _, fixed in repaired(_again(batch, it)):
                if fixed:
                    yield pa.RecordBatch.from_arrays([pa.array([c.conv_id] * len(fixed), types[0].type), pa.array(range(len(fixed)), pa.int64()), *(pa.array(x, pa.string()) for x in zip(*fixed, strict=True))], schema=types)

    small = rows if large is None else _matched(rows, large, "left_anti")
    found = small.repartition("conv_id").sortWithinPartitions("conv_id", *ORDER).mapInArrow(lines, f"conv_id {kind}, turn long, role string, text string")
    if large is None:
        return found
    work = Large(rows, large)

    def blocks(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, n = None, 0
        for cid, _, _, _, fixed in followed(it):
            current, n = (cid, n) if cid == current else (cid, 0)
            for role, text in fixed:
                yield pa.RecordBatch.from_pylist([{"cid": cid, "turn": n, "role": role, "text": text}], pa.schema([("cid", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())]))
                n += 1

    fixed = work.stream(work.audits()).mapInArrow(blocks, "cid long, turn long, role string, text string")
    return found.unionByName(large.join(fixed, "cid").select(names))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damage(read_table(spark, sf_dir, "conversations")))


#: the cheapest edits turn by turn, the least (cost, audit) a state; inserts before a turn and the edit are two small tables
ORACLE_SQL = r"""
WITH RECURSIVE tab AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc
), given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))), '..'), lambda p: CAST('0x' || p AS BIGINT))), lambda c, x: xor(c >> 8, crc[xor(c & 255, x) + 1])), 4294967295) % 20 AS kind
  FROM conversations, tab
), kept AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM given WHERE kind <> 0
), turns AS (
  SELECT conv_id, turn, role, text, left(role, 1) AS i, row_number() OVER o AS k, lag(left(role, 1)) OVER o AS b, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
         right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS z
  FROM kept WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), faults AS (
  SELECT *, z = '' AS blank, z <> '' AND again AS duplicate, z <> '' AND NOT again AND z NOT IN ('.', '!', '?') AS truncated FROM turns
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE duplicate) AS duplicate, count(*) FILTER (WHERE truncated) AS truncated,
         count(*) FILTER (WHERE b IS NOT NULL AND b || i NOT IN ('su', 'ua', 'au')) AS illegal FROM faults GROUP BY conv_id
), inserts(p, m, c, a, l) AS (
  VALUES (0, 0, 0, '', []::VARCHAR[]), (1, 1, 0, '', []), (2, 2, 0, '', []), (3, 3, 0, '', []), (0, 2, 2, 'I', ['user:']), (1, 2, 2, 'I', ['user:']), (3, 2, 2, 'I', ['user:']), (2, 3, 2, 'I', ['assistant:']), (0, 3, 4, 'II', ['user:', 'assistant:']), (1, 3, 4, 'II', ['user:', 'assistant:'])
), moves(m, q, r, name) AS (
  VALUES (0, 1, 's', NULL), (0, 2, 'u', 'user'), (1, 2, 'u', 'user'), (3, 2, 'u', 'user'), (2, 3, 'a', 'assistant')
), edits AS (
  SELECT conv_id, k, m, m AS q, 3 AS c, 'D' AS a, []::VARCHAR[] AS l FROM faults, (SELECT unnest(range(4)) AS m)
  UNION ALL SELECT conv_id, k, m, q, truncated::INT, 'K', [role || ':' || text] FROM faults JOIN moves ON r = i WHERE NOT blank AND NOT duplicate
  UNION ALL SELECT conv_id, k, m, q, 2 + truncated::INT, 'R', [name || ':' || text] FROM faults, moves WHERE name IS NOT NULL AND NOT blank AND NOT duplicate
), states AS (
  SELECT DISTINCT conv_id, 0 AS k, 0 AS q, lpad('0', 10, '0') AS best, []::VARCHAR[] AS lines FROM conversations
  UNION ALL
  SELECT conv_id, k, q, min(best), arg_min(lines, best) FROM (
    SELECT s.conv_id, s.k + 1 AS k, e.q, lpad((left(best, 10)::INT + n.c + e.c)::VARCHAR, 10, '0') || substr(best, 11) || n.a || e.a AS best, list_concat(list_concat(lines, n.l), e.l) AS lines
    FROM states s JOIN inserts n ON n.p = s.q JOIN edits e ON e.conv_id IS NOT DISTINCT FROM s.conv_id AND e.k = s.k + 1 AND e.m = n.m
  ) GROUP BY conv_id, k, q
), ended AS (
  SELECT conv_id, min(best) AS best, arg_min(lines, best) AS lines FROM (
    SELECT s.conv_id, lpad((left(best, 10)::INT + n.c)::VARCHAR, 10, '0') || substr(best, 11) || n.a AS best, list_concat(lines, n.l) AS lines
    FROM states s JOIN (SELECT conv_id, max(k) AS k FROM states GROUP BY conv_id) x ON x.conv_id IS NOT DISTINCT FROM s.conv_id AND x.k = s.k JOIN inserts n ON n.p = s.q AND n.m IN (0, 3)
  ) GROUP BY conv_id
)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, left(best, 10)::BIGINT AS cost, substr(best, 11) AS audit, sha256(array_to_string(lines, chr(10))) AS repaired_sha256
FROM ended e LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
"""
