"""Secret scans: three fixed patterns, and Shannon entropy in a window that slides over candidate strings.

A candidate is a run of 20 or more token characters with a letter and a digit.  A window of 20 characters slides over
it; the counts of its characters and the sum of c*log2(c) are updated by the character that leaves and the one that
enters.  A window counts when its entropy reaches the bound of its character class (hexadecimal, alphanumeric, or with
the marks of base64).  Windows that touch are joined to one span.  Allow-listed candidates and the parts of a span that a
pattern's span covers are left out.  Allowed are identifiers in the 8-4-4-4-12 form, what belongs to a URL however long it
is, paths whose segments are all made of words, short values with a placeholder as a whole word, and published examples.
A URL ends at a blank, quote, bracket, comma, semicolon, bar or backslash.

Texts are worked on one at a time inside Arrow batches, in time that grows with their length; nothing is shuffled.

Defined cases: null and empty texts have no spans; very long texts are scanned whole; repeated rows, and rows with one
doc_id, are scanned each by itself; an empty table gives no rows; only doc_id and text are read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framespan.llm._common import read_documents
from framespan.llm._vec import release

KINDS = ("assign", "access", "hex", "entropy")
#: pattern, group whose length counts, least length
PATTERNS = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    # a run of 24 or more is a longest run of any length with 24 or more characters
    "hex": (re.compile(r"[0-9a-f]{24,}"), 0, 24),
}
WINDOW = 20
#: bits a character that a window of the class needs
BOUNDS = {"hex": 2.9, "alnum": 3.6, "base64": 3.8}
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
_PART = r"(?:[A-Z]?[a-z]+(?:[A-Z][a-z]{2,})*|[A-Z]+)[0-9]{0,4}"
_SEGMENT = rf"{_PART}(?:[_-]{_PART})*"
ALLOWED = [
    re.compile(r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"),
    re.compile(rf"/?{_SEGMENT}(?:/{_SEGMENT})+/?"),
]
PLACEHOLDER = re.compile(r"(?i)(?<![a-z0-9])(?:example|sample|placeholder|changeme|x{4,}|0123456789|abcdefgh)(?![a-z0-9])")
#: fixed values: keys that a provider's public manual prints as examples
EXAMPLES = frozenset({"wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY"})
#: characters of a value that a placeholder's word can excuse
SHORT = 2 * WINDOW
URL = re.compile(r"""://[^\s"'`\u2018-\u201f\u00ab\u00bb()\[\]{}<>,;|\\]*""")
_HEX, _ALNUM = frozenset("0123456789abcdefABCDEF"), re.compile(r"[A-Za-z0-9]+")
_CLOG = [0.0] + [c * math.log2(c) for c in range(1, WINDOW + 1)]


def class_of(text: str) -> str:
    return "hex" if _HEX.issuperset(text) else "alnum" if _ALNUM.fullmatch(text) else "base64"


def windows_above(text: str, bound: float, width: int = WINDOW) -> Iterator[tuple[int, int]]:
    """Joined spans of the windows whose entropy reaches the bound."""
    counts: dict[str, int] = {}
    total, first, last = 0.0, -1, -1
    need = width * (math.log2(width) - bound) + 1e-9  # entropy = log2(width) - total / width
    for i, c in enumerate(text):
        n = counts.get(c, 0)
        total += _CLOG[n + 1] - _CLOG[n]
        counts[c] = n + 1
        if i >= width:
            out = text[i - width]
            n = counts[out]
            total += _CLOG[n - 1] - _CLOG[n]
            counts[out] = n - 1
        if i >= width - 1 and total <= need:
            begin = i - width + 1
            if last >= begin:
                last = i + 1
            else:
                if last >= 0:
                    yield first, last
                first, last = begin, i + 1
    if last >= 0:
        yield first, last


def placeholder(text: str) -> bool:
    """Whether the value, what follows the last '=' before any padding, is short and holds a placeholder's word, and no long part before it is another value."""
    *names, value = text.rstrip("=").split("=")
    return all(len(p) <= SHORT and PLACEHOLDER.search(p) for p in [value, *(n for n in names if len(n) >= WINDOW)])


def allowed(text: str) -> bool:
    return text in EXAMPLES or any(p.fullmatch(text) for p in ALLOWED) or placeholder(text)


def pattern_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the three patterns, leftmost and non-overlapping by kind, too short ones dropped."""
    found = []
    for kind, (pattern, group, least) in PATTERNS.items():
        k = KINDS.index(kind)
        found += [(m.start(), k, m.end()) for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least]
    return sorted(found)


def covered(taken: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """The places of spans in order of start, as runs without a common place."""
    runs: list[tuple[int, int]] = []
    for start, _, end in taken:
        if runs and start <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(end, runs[-1][1]))
        else:
            runs.append((start, end))
    return runs


def outside(spans: Iterable[tuple[int, int]], runs: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """The parts of the spans outside the runs; both are in order and walked once."""
    at = 0
    for a, b in spans:
        while at < len(runs) and runs[at][1] <= a:
            at += 1
        k = at
        while k < len(runs) and runs[k][0] < b:
            if a < runs[k][0]:
                yield a, runs[k][0]
            a = max(a, runs[k][1])
            k += 1
        if a < b:
            yield a, b


def candidate_spans(text: str) -> Iterator[tuple[int, int]]:
    """Spans of high entropy of the candidates that are not allowed, in order."""
    urls = [m.span() for m in URL.finditer(text)] if "://" in text else []
    at = 0
    for m in CANDIDATE.finditer(text):
        while at < len(urls) and urls[at][1] < m.start():
            at += 1
        s = m[0]
        if at < len(urls) and urls[at][0] < m.start() or not any(map(str.isdigit, s)) or not any(map(str.isalpha, s)) or allowed(s):
            continue
        for a, b in windows_above(s, BOUNDS[class_of(s)]):
            yield a + m.start(), b + m.start()


def entropy_spans(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the entropy spans, without what those taken, in order of start, cover."""
    return [(a, KINDS.index("entropy"), b) for a, b in outside(candidate_spans(text), covered(taken))]


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id and the spans of each text: base and all, as arrays of (kind, start, end), in order of start and kind."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in it:
            base, every = [], []
            for value in batch.column(1):
                text = value.as_py() or ""
                found = pattern_spans(text)
                base.append([{"kind": KINDS[k], "start": a, "end": b} for a, k, b in found])
                every.append([{"kind": KINDS[k], "start": a, "end": b} for a, k, b in sorted(found + entropy_spans(text, found))])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(base, span), pa.array(every, span)], names=["doc_id", "base", "spans"])

    return docs.select("doc_id", "text").mapInArrow(batches, "doc_id long, base array<struct<kind:string,start:long,end:long>>, spans array<struct<kind:string,start:long,end:long>>")


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """The documents with every span replaced by the mark; n_chars, where there, follows the new text."""
    names, has_size = docs.columns, "n_chars" in docs.columns
    at = names.index("text")

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in it:
            texts = []
            for value in batch.column(at):
                text = value.as_py()
                if text:
                    found = pattern_spans(text)
                    parts, to = [], 0
                    for a, _, b in sorted(found + entropy_spans(text, found)):
                        if b > to:
                            parts += [text[to:a], mark] if a >= to else []
                            to = b
                    text = "".join(parts) + text[to:]
                texts.append(text)
            columns = list(batch.columns)
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            if has_size:
                i = names.index("n_chars")
                columns[i] = pa.array([None if t is None else len(t) for t in texts], batch.schema.field(i).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(batches, docs.schema)


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(read_documents(spark, sf_dir))

    def text(spans: str):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, KINDS[:3]), F.sha2(text("base").cast("binary"), 256).alias("base_sha256"), text("spans").alias("spans"))


def _placed(name: str, pattern: str) -> str:
    """SQL of a table of the pattern's matches in every text: row_id, start, stop and m."""
    pattern = pattern.replace("'", "''")
    return f"""{name}_all AS (SELECT row_id, string_split_regex(t, '{pattern}') AS gaps, regexp_extract_all(t, '{pattern}') AS ms FROM d WHERE regexp_matches(t, '{pattern}')),
{name} AS (SELECT row_id, start, start + length(m) AS stop, m FROM (SELECT row_id, unnest(ms) AS m, unnest(list_transform(range(1, len(ms) + 1), lambda j: list_sum(list_transform(gaps[1:j], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:j - 1], lambda x: length(x))), 0)))::BIGINT AS start FROM {name}_all))"""


def _oracle_sql() -> str:
    """Spans by regular expressions and their places; entropy from the counts of every window's characters."""
    either = lambda word: "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)
    names = "|".join(either(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
    blank = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
    url = rf"""://[^{blank}"'`\x{{2018}}-\x{{201f}}\x{{ab}}\x{{bb}}()\[\]{{}}<>,;|\\]*"""
    word = "(?i)(^|[^a-z0-9])(?:example|sample|placeholder|changeme|x{4,}|0123456789|abcdefgh)($|[^a-z0-9])"
    tables = [
        _placed("assign", rf"""(?:{names})["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""), _placed("access", "AKIA[A-Z0-9]+"), _placed("hex", "[0-9a-f]{24,}"),
        _placed("candidate", CANDIDATE.pattern), _placed("url", url),
    ]
    value = rf"""^(?:{names})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$""".replace("'", "''")
    examples = ", ".join(f"'{x}'" for x in EXAMPLES)
    shapes = " OR ".join(f"regexp_full_match(m, '{p.pattern}')" for p in ALLOWED)
    return f"""
WITH d AS (SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS t FROM documents), {", ".join(tables)},
base AS (SELECT row_id, start, 0 AS kind, stop FROM assign WHERE length(regexp_extract(m, '{value}', 1)) >= 6
  UNION ALL SELECT row_id, start, 1, stop FROM access WHERE length(m) >= 20 UNION ALL SELECT row_id, start, 2, stop FROM hex),
open AS (SELECT c.*, string_split(rtrim(m, '='), '=') AS parts FROM candidate c WHERE regexp_matches(m, '[0-9]') AND regexp_matches(m, '[A-Za-z]') AND m NOT IN ({examples}) AND NOT ({shapes})
  AND NOT EXISTS (SELECT 1 FROM url u WHERE u.row_id = c.row_id AND u.start < c.start AND u.stop >= c.start)),
judged AS (SELECT row_id, start, m, CASE WHEN regexp_full_match(m, '[0-9a-fA-F]+') THEN {BOUNDS["hex"]} WHEN regexp_full_match(m, '[A-Za-z0-9]+') THEN {BOUNDS["alnum"]} ELSE {BOUNDS["base64"]} END AS bound FROM open
  WHERE len(list_filter(parts, lambda p, i: (i = len(parts) OR length(p) >= {WINDOW}) AND NOT (length(p) <= {SHORT} AND regexp_matches(p, '{word}')))) > 0),
windows AS (SELECT row_id, start AS origin, bound, unnest(range(length(m) - {WINDOW - 1})) AS i, m FROM judged),
hits AS (SELECT row_id, origin, origin + i AS place FROM windows WHERE list_sum(list_transform(map_values(list_histogram(string_split(substr(m, i + 1, {WINDOW}), ''))), lambda c: c * log2(c))) <= {WINDOW} * (log2({WINDOW}) - CAST(bound AS DOUBLE)) + 1e-9),
cells AS (SELECT row_id, origin, island, unnest(range(min(place), max(place) + {WINDOW})) AS place FROM (SELECT *, sum(fresh) OVER (PARTITION BY row_id, origin ORDER BY place) AS island FROM (SELECT *, CASE WHEN place - lag(place) OVER (PARTITION BY row_id, origin ORDER BY place) <= {WINDOW} THEN 0 ELSE 1 END AS fresh FROM hits)) GROUP BY row_id, origin, island),
bare AS (SELECT * FROM cells c WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.row_id = c.row_id AND b.start <= c.place AND b.stop > c.place)),
high AS (SELECT row_id, min(place) AS start, 3 AS kind, max(place) + 1 AS stop FROM (SELECT *, place - row_number() OVER (PARTITION BY row_id, origin, island ORDER BY place) AS run FROM bare) GROUP BY row_id, origin, island, run),
both_ AS (SELECT *, ['{"', '".join(KINDS)}'][kind + 1] || ':' || start || ':' || stop AS span FROM (SELECT * FROM base UNION ALL SELECT * FROM high)),
listed AS (SELECT row_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex, string_agg(span, ',' ORDER BY start, kind, stop) FILTER (kind < 3) AS base, string_agg(span, ',' ORDER BY start, kind, stop) AS spans FROM both_ GROUP BY 1)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN listed USING (row_id)
"""


ORACLE_SQL = _oracle_sql()
