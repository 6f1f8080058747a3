"""Byte-level BPE by a lazily determinised finite-state transducer, and a streaming decoder.

A sequence of tokens is what the merges make of its bytes exactly when the merges leave every pair of neighbours as it
is.  So encoding is a finite-state relation: a configuration is (last token, bytes of the token being read, tokens not
yet emitted), reading a byte extends the open token, and a complete token that suits the last one opens the next.
Several configurations live at once; determinisation puts them in one state and emits what all of them have in
common, so a token leaves as soon as no continuation can change it: after fewer bytes than the longest token has.
States and transitions are made when first needed and dropped together when there are too many.

Texts are split by the public pattern and every match is encoded by itself; matches met before come from a bounded
table.  Documents are encoded and decoded inside Arrow batches: no shuffle, and the vocabulary (fixed size) is
broadcast.

Defined cases: null and empty texts have no tokens; very long texts are encoded whole; repeated rows are encoded each by
itself, and there are no ties; an empty table gives no rows; only doc_id, text and the columns to keep are read.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from framespan.llm._common import read_documents
from framespan.llm._vec import KEPT, release

#: states of the transducer and remembered matches (of each of two generations), before they are dropped; a state takes
#: about 350 bytes, a match about 250
MOST_STATES = 320_000
MOST_MATCHES = 120_000


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to id, of a file of base64 tokens and ranks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class Transducer:
    """States are numbers; what a state stands for, its configurations, is packed in 32-bit integers: last token,
    node of the prefix tree of tokens, and the count and ids of the tokens not yet emitted.

    The configuration without an open token (node 0) comes first; it says how the text so far is encoded."""

    def __init__(self, ranks: dict[bytes, int], most_states: int = MOST_STATES):
        self.ranks, self.most = ranks, most_states
        self.tokens = {i: t for t, i in ranks.items()}
        self.halves: dict[int, tuple[int, int] | None] = {}
        # the prefix tree: children by node * 256 + byte, the token of each node or -1, and whether it has children
        self.child: dict[int, int] = {}
        self.token, self.inner = [-1], [True]
        for text, rank in ranks.items():
            node = 0
            for byte in text:
                self.inner[node] = True
                at = node << 8 | byte
                node = self.child.setdefault(at, len(self.token))
                if node == len(self.token):
                    self.token.append(-1)
                    self.inner.append(False)
            self.token[node] = rank
        self._forget()

    def _forget(self) -> None:
        self.states: dict[bytes, int] = {}
        self.configs: list[bytes] = []
        # by state * 256 + byte: the next state's number * 256, or that and what is emitted
        self.next: dict[int, int | tuple[int, tuple[int, ...]]] = {}
        self.start = self._state(array("i", (-1, 0, 0)).tobytes())

    def merged(self, data: bytes, below: float = float("inf")) -> list[bytes]:
        """What the merges of a rank below the bound make of the bytes: in order of rank, the leftmost first."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            found = [(self.ranks.get(a + b, below), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))]
            rank, i = min(found)
            if rank >= below:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens that the last merge joins to this one; None for a byte, or if the merges can't make it."""
        found = self.halves.get(token, ())
        if found == ():
            parts = self.merged(self.tokens[token], token)
            found = self.halves[token] = (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else None
        return found

    def _suit(self, left: int, right: int) -> bool:
        """Whether the merges leave the two tokens side by side.

        Undoes their merges, the latest first: at no time may the two tokens that face each other across the border
        have had a merge that came before the one just undone."""
        tokens, ranks = self.tokens, self.ranks
        if left < 0:
            return len(tokens[right]) == 1 or self._halves(right) is not None
        bound = float("inf")
        while True:
            if ranks.get(tokens[left] + tokens[right], bound) < bound:
                return False
            a, b = self._halves(left), self._halves(right)
            if a is None and b is None:
                return True
            if b is None or (a is not None and left > right):
                bound, left = left, a[1]
            else:  # of equal ranks the left one comes first, so a tie would be merged across the border
                bound, right = right + 1, b[0]

    def _state(self, configs: bytes) -> int:
        state = self.states.get(configs)
        if state is None:
            state = self.states[configs] = len(self.configs) << 8
            self.configs.append(configs)
        return state

    def _step(self, state: int, byte: int) -> int | tuple[int, tuple[int, ...]]:
        """Determinises one transition."""
        grown, packed, at = [], memoryview(self.configs[state >> 8]).cast("i"), 0
        child, tokens, inner = self.child, self.token, self.inner
        while at < len(packed):
            last, part, n = packed[at : at + 3]
            rest = packed[at + 3 : at + 3 + n].tolist()
            at += 3 + n
            part = child.get(part << 8 | byte)
            if part is not None:
                token = tokens[part]
                if token >= 0 and self._suit(last, token):
                    grown.append((0, token, [*rest, token]))
                if inner[part]:
                    grown.append((part, last, rest))
        first, shared = grown[0][2], 0
        for ids in zip(*(rest for _, _, rest in grown), strict=False):
            if ids.count(first[shared]) < len(ids):
                break
            shared += 1
        out = array("i")
        for part, last, rest in sorted(grown):
            out.extend((last, part, len(rest) - shared))
            out.extend(rest[shared:])
        to = self._state(out.tobytes())
        made = self.next[state | byte] = (to, tuple(first[:shared])) if shared else to
        return made

    def encode(self, data: bytes) -> tuple[int, ...]:
        if len(self.configs) >= self.most:
            self._forget()
        state, out, found = self.start, [], self.next.get
        for byte in data:
            step = found(state | byte)
            if step is None:
                step = self._step(state, byte)
            if step.__class__ is int:
                state = step
            else:
                state = step[0]
                out += step[1]
        packed = memoryview(self.configs[state >> 8]).cast("i")
        out += packed[3 : 3 + packed[2]]
        return tuple(out)

    def feed(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        """The state after one more byte, and the tokens that leave."""
        step = self.next.get(state | byte)
        step = self._step(state, byte) if step is None else step
        return (step, ()) if step.__class__ is int else step

    def waiting(self, state: int) -> list[int]:
        """Tokens that are read but not yet emitted."""
        packed = memoryview(self.configs[state >> 8]).cast("i")
        return packed[3 : 3 + packed[2]].tolist()


class Encoder:
    """Splits a text by the pattern and encodes every match; two generations of a table remember matches."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, most_states: int = MOST_STATES, most_matches: int = MOST_MATCHES):
        self.transducer = Transducer(ranks, most_states)
        self.split = regex.compile(pattern).findall
        self.seen: dict[str, tuple[int, ...]] = {}
        self.before: dict[str, tuple[int, ...]] = {}
        self.most = most_matches

    def _ids(self, match: str) -> tuple[int, ...]:
        ids = self.before.get(match)
        if ids is None:
            data = match.encode()
            whole = self.transducer.ranks.get(data)  # a token is itself, also if no merges lead to it
            ids = self.transducer.encode(data) if whole is None else (whole,)
        if len(match) <= 64:
            if len(self.seen) >= self.most:
                self.before, self.seen = self.seen, {}
            self.seen[match] = ids
        return ids

    def __call__(self, text: str) -> list[int]:
        matches = self.split(text)
        parts = list(map(self.seen.get, matches))
        try:
            at = -1
            while True:
                at = parts.index(None, at + 1)
                parts[at] = self.seen.get(matches[at]) or self._ids(matches[at])
        except ValueError:  # none is left
            return list(chain.from_iterable(parts))


#: classes of bytes in UTF-8: lead bytes say how many bytes follow
_FOLLOW = [0] * 0xC0 + [1] * 0x20 + [2] * 0x10 + [3] * 0x08 + [0] * 0x08


class Utf8Stream:
    """Incremental UTF-8: bytes may come in any pieces; a character leaves when its last byte is there.

    The state is the bytes of the open character, at most three.  Malformed bytes become U+FFFD."""

    def __init__(self):
        self.open = b""

    def feed(self, data: bytes) -> str:
        data = self.open + data
        n = len(data)
        cut = n
        for back in range(1, min(3, n) + 1):  # an open character's lead byte is among the last three
            byte = data[n - back]
            if byte >= 0xC0:
                if _FOLLOW[byte] >= back:
                    cut = n - back
                break
            if byte < 0x80:
                break
        self.open = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def close(self) -> str:
        rest, self.open = self.open, b""
        return rest.decode("utf-8", "replace")


def decode_stream(ids: Iterable[int], tokens: dict[int, bytes], block: int = 4096) -> Iterator[str]:
    """Text of a stream of ids, piece by piece."""
    stream, ids = Utf8Stream(), iter(ids)
    while held := b"".join(map(tokens.__getitem__, islice(ids, block))):
        yield stream.feed(held)
    yield stream.close()


_encoders: dict[tuple, Encoder] = {}
KEPT.append(_encoders)


def _encoder(key: tuple, ranks: dict[bytes, int], pattern: str, share: int = 1) -> Encoder:
    """One encoder a worker process, so that its states serve all batches; tasks of other operators drop it."""
    release(_encoders)  # what earlier stages left in this worker, before the tables are made
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(ranks, pattern, MOST_STATES // share, MOST_MATCHES // share)
    return _encoders[key]


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, *keep: str, share: int = 1) -> DataFrame:
    """The kept columns and the ids of every text.

    Tables of states and matches take 1 / share of their usual bounds; the ids do not depend on it."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)  # the vocabulary: of fixed size
    key = (len(ranks), pattern, hash(frozenset(ranks.items())), share)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(key, shared.value, pattern, share)
        for batch in it:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                ids = pa.array([encoder(x.as_py() or "") for x in part.column(part.num_columns - 1)], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], ids], names=[*keep, "ids"])

    schema = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)
    return docs.select(*keep, "text").mapInArrow(batches, f"{schema}ids array<int>")


def decode(encoded: DataFrame, ranks: dict[bytes, int], *keep: str) -> DataFrame:
    """The kept columns and the text of every list of ids."""
    shared = encoded.sparkSession.sparkContext.broadcast(ranks)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = {i: t for t, i in shared.value.items()}
        for batch in it:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                texts = pa.array(["".join(decode_stream(x.as_py() or (), tokens)) for x in part.column(part.num_columns - 1)], pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], texts], names=[*keep, "text"])

    schema = "".join(f"`{c}` {encoded.schema[c].dataType.simpleString()}, " for c in keep)
    return encoded.select(*keep, "ids").mapInArrow(batches, f"{schema}text string")


def digests(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """Per document the number of tokens and the digests of the ids and of the bytes decoded from them.

    Encodes and decodes in one pass, so that ids need not leave the task."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    key = (len(ranks), pattern, hash(frozenset(ranks.items())))

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(key, shared.value, pattern)
        tokens = encoder.transducer.tokens
        text_of = {i: str(i) for i in tokens}
        for batch in it:
            counts, of_ids, of_text = [], [], []
            for value in batch.column(1):
                ids = encoder(value.as_py() or "")
                counts.append(len(ids))
                of_ids.append(hashlib.sha256(" ".join(map(text_of.__getitem__, ids)).encode()).hexdigest())
                decoded = hashlib.sha256()
                for piece in decode_stream(ids, tokens):
                    decoded.update(piece.encode())
                of_text.append(decoded.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(batches, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def public_vocabulary(path: str | None = None) -> tuple[dict[bytes, int], str]:
    """Ranks and pattern of the public 50k vocabulary, or of another rank file."""
    import public_tokenizers

    return load_ranks(path or public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(read_documents(spark, sf_dir), *public_vocabulary())
