"""Quality rules as a short-circuit cascade.

Every rule's rejection rate and cost are measured on a bounded sample of rows; the rules then run in the order of
rejection per cost, the best first, each only on rows that no earlier rule has rejected (one CASE expression, so the
order is Spark's own short circuit).  The order changes the work, never the verdict.

All expressions are built-in Spark functions.

Defined cases: null and empty texts have no words and fail the base; very long texts are judged whole; repeated rows, and
rows with one doc_id, are judged each by itself; an empty table gives no rows; other columns of the input are ignored by the query and passed through by `apply_cascade`.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framespan.llm._common import BLANKS, WORD, cut, let, read_documents

#: Rows of the sample on which rules are measured.
SAMPLE_ROWS = 2000
#: times that a rule judges a row of the sample when its cost is measured
REPEAT = 10
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """reject is true for rows to reject; a null counts as not rejected."""

    name: str
    reject: Column


@dataclass(frozen=True)
class Measured:
    rule: Rule
    rejected: float
    seconds: float

    @property
    def gain(self) -> float:
        return self.rejected / max(self.seconds, 1e-6)


def measure(sample: DataFrame, rules: list[Rule], repeat: int = REPEAT) -> list[Measured]:
    """Share of rows rejected and seconds a row of each rule on a materialised sample, the best gain first.

    Every row is judged `repeat` times, so that a rule's work stands out from the job around it; of three runs in turn
    the fastest counts, and the time of a job without a rule is taken off.  Names break ties."""
    rows = sample.count()
    if not rows:
        return [Measured(r, 0.0, 0.0) for r in rules]
    many = sample.withColumn("_turn", F.explode(F.sequence(F.lit(1), F.lit(repeat))))

    def timed(column: Column) -> tuple[float, float]:
        began = time.perf_counter()
        # the turn is a part of the condition, so that it can't be judged once for all turns
        value = many.agg(F.avg(F.coalesce(column & (F.col("_turn") > 0), F.lit(False)).cast("int")).alias("v")).first()["v"]
        return float(value), time.perf_counter() - began

    conditions = [F.length("text") < 0, *(r.reject for r in rules)]
    runs = [[timed(c) for c in conditions] for _ in range(3)]
    idle = min(run[0][1] for run in runs)
    found = []
    for k, rule in enumerate(rules, 1):
        seconds = min(run[k][1] for run in runs)
        found.append(Measured(rule, runs[0][k][0], max(seconds - idle, 1e-4) / (rows * repeat)))
    return sorted(found, key=lambda m: (-m.gain, m.rule.name))


def sample_rows(docs: DataFrame, rows: int = SAMPLE_ROWS, seed: int = 7) -> DataFrame:
    """At most about `rows` rows drawn at random from the whole table, materialised."""
    total = docs.count()
    part = docs.sample(min(1.0, rows / total), seed) if total > rows else docs
    return cut(part)


def apply_cascade(docs: DataFrame, rules: list[Rule], sample: DataFrame, *, before: Column | None = None) -> DataFrame:
    """Adds rejected_by, the first rule in cascade order that rejects the row, or null.

    The order is measured on `sample`, a materialised part of the rows.  Rows for which `before` holds are not judged."""
    verdict = F.when(before if before is not None else F.lit(False), F.lit(None).cast("string"))
    for found in measure(sample, rules):
        verdict = verdict.when(found.rule.reject, F.lit(found.rule.name))
    return docs.withColumn("rejected_by", verdict)


def word_list(text: Column) -> Column:
    return F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), BLANKS, " " * len(BLANKS)), " "), lambda w: w != "")


def non_blank_chars(text: Column) -> Column:
    return F.length(F.translate(F.coalesce(text, F.lit("")), BLANKS, ""))


def symbol_count(text: Column) -> Column:
    whole = F.coalesce(text, F.lit(""))
    return F.length(whole) - F.length(F.translate(whole, SYMBOLS, ""))


def repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: F.translate(x, BLANKS, "") != "")
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def repeated_words(words: Column, width: int = 5) -> Column:
    """Words that lie in a window of `width` words found twice or more in the text, the first included.

    Windows are compared by hash first; only texts with equal hashes sort them, and equal neighbours are compared
    by their words."""

    def windows(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - width), lambda i: F.xxhash64(*[w[i + k] for k in range(width)]))

    def covered(w: Column, h: Column) -> Column:
        ranked = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def places(s: Column) -> Column:
            same = F.zip_with(F.slice(s, 1, F.size(s) - 1), F.slice(s, 2, F.size(s) - 1), lambda a, b: F.when((a["h"] == b["h"]) & (F.slice(w, a["i"] + 1, width) == F.slice(w, b["i"] + 1, width)), F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>")))
            return F.sort_array(F.array_distinct(F.flatten(F.filter(same, lambda x: F.size(x) > 0))))

        start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        step = lambda acc, p: F.struct((acc["n"] + p + width - F.greatest(acc["end"], p)).cast("int").alias("n"), (p + width).cast("int").alias("end"))
        return F.aggregate(let(ranked, places), start, step, lambda acc: acc["n"])

    return let(
        words,
        lambda w: F.when(F.size(w) <= width, F.lit(0)).otherwise(let(windows(w), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(w, h)))),
    )


def default_rules(text: str = "text", measured: dict[str, Column] | None = None) -> list[Rule]:
    """Rules on the whole text; bounds are shares of characters, words or lines in percent.

    measured: columns that hold chars, symbols, words or dup_lines already; others are taken from the text."""
    t = F.coalesce(F.col(text), F.lit(""))
    have = {"chars": lambda: non_blank_chars(F.col(text)), "symbols": lambda: symbol_count(F.col(text)), "words": lambda: F.regexp_count(t, F.lit(WORD)), "dup_lines": lambda: repeated_lines(F.col(text))}
    chars, symbols, words, dup_lines = ((measured or {}).get(n, make()) for n, make in have.items())
    letters, capitals = (F.length(t) - F.length(F.regexp_replace(t, p, "")) for p in (r"\p{L}+", r"\p{Lu}+"))
    bangs = F.length(t) - F.length(F.translate(t, "!", ""))
    lines = F.length(t) - F.length(F.translate(t, "\n", "")) + 1
    return [
        Rule("symbols", 100 * symbols > 5 * chars),
        Rule("capitals", 100 * capitals > 40 * letters),
        Rule("exclamations", 100 * bangs > 50 * words),
        Rule("repeated_lines", let(dup_lines, lambda n: (n >= 3) & (100 * n > 30 * lines))),
        Rule("few_letters", 100 * letters < 50 * chars),
        Rule("word_length", (chars < 2 * words) | (chars > 20 * words)),
    ]


def base_measures(docs: DataFrame) -> DataFrame:
    """doc_id, text and the base measures of the contract."""
    measured = docs.select("doc_id", "text", word_list(F.col("text")).alias("_w"), non_blank_chars(F.col("text")).alias("word_chars"), symbol_count(F.col("text")).alias("n_symbols"), repeated_lines(F.col("text")).alias("n_dup_lines"))
    measured = measured.select("doc_id", "text", F.size("_w").cast("long").alias("n_words"), *[F.col(c).cast("long").alias(c) for c in ("word_chars", "n_symbols", "n_dup_lines")], repeated_words(F.col("_w")).cast("long").alias("n_repeat_words"))
    return measured.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))


def op2_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir).select("doc_id", "text")
    rules = default_rules(measured={"chars": F.col("word_chars"), "symbols": F.col("n_symbols"), "words": F.col("n_words"), "dup_lines": F.col("n_dup_lines")})
    sample = cut(base_measures(sample_rows(docs)))
    judged = apply_cascade(base_measures(docs), rules, sample, before=F.col("base_failed"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & F.col("rejected_by").isNull()).alias("kept"))


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         row_number() OVER () AS row_id
  FROM documents
), lines AS (
  SELECT row_id, sum(n) - count(*) AS dup FROM (
    SELECT row_id, line, count(*) AS n FROM (SELECT row_id, unnest(string_split(t, chr(10))) AS line FROM d)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY row_id, line
  ) GROUP BY row_id
), grams AS (
  SELECT row_id, i, w[i:i+4] AS g FROM (SELECT row_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)
), starts AS (
  SELECT row_id, i FROM (SELECT row_id, i, count(*) OVER (PARTITION BY row_id, g) AS n FROM grams) WHERE n > 1
), reps AS (
  SELECT row_id, count(DISTINCT i + k) AS n FROM starts, (SELECT unnest(range(0, 5)) AS k) GROUP BY row_id
), m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         coalesce(lines.dup, 0)::BIGINT AS n_dup_lines, coalesce(reps.n, 0)::BIGINT AS n_repeat_words,
         len(string_split(t, chr(10))) AS n_lines, len(regexp_extract_all(t, '\p{L}')) AS letters,
         len(regexp_extract_all(t, '\p{Lu}')) AS capitals, length(t) - length(replace(t, '!', '')) AS bangs
  FROM d LEFT JOIN lines USING (row_id) LEFT JOIN reps USING (row_id)
), f AS (SELECT *, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (100 * n_symbols > 5 * word_chars OR 100 * capitals > 40 * letters OR 100 * bangs > 50 * n_words
         OR (n_dup_lines >= 3 AND 100 * n_dup_lines > 30 * n_lines) OR 100 * letters < 50 * word_chars
         OR word_chars < 2 * n_words OR word_chars > 20 * n_words) AS kept
FROM f
"""
