"""Quality rules whose thresholds follow each language and source.

Every document gets counts from its whole text. Each measure goes into a quantile sketch per
(language, source): a histogram over buckets of constant relative width, whose counts add up when
sketches are merged, so it is an ordinary grouped count. A group's sketch is blended with that of
its language, and the language's with that of all rows, each parent weighing as much as
``PRIOR`` documents; small groups thereby lean on their parents, large ones decide for themselves.
A document is rejected when a measure lies outside its group's fence.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import documents, fresh, stage, stored, words_of

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
#: Documents that a parent sketch counts as.
PRIOR = 200.0
#: Sketch: values below START share bucket 0; the others' buckets widen by GROWTH.
START, GROWTH = 1e-3, 1.05
#: Measure -> least spread. The fence is median + FENCE * max(upper quartile - median, least spread).
SPREADS = {"symbols": 0.02, "upper": 0.05, "dup_lines": 0.12, "repeats": 0.06, "stutter": 0.06, "word_length": 0.6}
FENCE = 6.0

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_WINDOW = 8
_MIX = np.uint64(0x9E3779B97F4A7C15)

COUNTS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_lines",
    "n_dup_lines",
    "n_repeat_words",
    "n_upper",
    "n_letters",
    "n_stutter",
)


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in an 8-word window found at least twice, its first occurrence included."""
    n = len(words)
    if n <= _WINDOW:
        return 0
    ids: dict[bytes, int] = {}
    ranks = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    hashed = ranks.astype(np.uint64) * _MIX
    hashed ^= hashed >> np.uint64(29)
    for step in (1, 2, 4):
        hashed = hashed[:-step] * _MIX + (hashed[step:] ^ (hashed[step:] >> np.uint64(31)))
    hashed.sort()
    if not (hashed[1:] == hashed[:-1]).any():  # equal windows have equal hashes
        return 0
    for step in (1, 2, 4):  # exact: the rank of each window from the ranks of its halves
        ranks = np.unique(ranks[:-step] * (ranks.max() + 1) + ranks[step:], return_inverse=True)[1]
    start = np.flatnonzero(np.bincount(ranks)[ranks] > 1)
    cover = np.zeros(n + 1, np.int64)
    np.add.at(cover, start, 1)
    np.add.at(cover, start + _WINDOW, -1)
    return int((cover[:n].cumsum() > 0).sum())


def measure(text: str | None) -> tuple[int, ...]:
    """The counts of COUNTS over a whole text; zeros for null."""
    if not text:
        return (0,) * len(COUNTS)
    words = words_of(text)
    lines = text.split("\n")
    full = [x for x in lines if x.strip(BLANKS)]
    raw = text.encode("utf-8", "replace")
    upper = len(raw) - len(raw.translate(None, _UPPER))
    return (
        len(words),
        len(text) - sum(text.count(c) for c in BLANKS),
        sum(text.count(c) for c in SYMBOLS),
        len(full),
        len(full) - len(set(full)),
        repeated_words(words),
        upper,
        upper + len(raw) - len(raw.translate(None, _LOWER)),
        sum(map(eq, words, words[1:])),
    )


@F.pandas_udf(T.StructType([T.StructField(c, T.LongType()) for c in COUNTS]))
def counts(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in texts:
        yield pd.DataFrame([measure(t) for t in batch], columns=list(COUNTS))


def _measures(m: str) -> dict[str, Column]:
    part = lambda a, b: F.col(f"{m}.{a}") / F.greatest(F.col(f"{m}.{b}"), F.lit(1))
    return {
        "symbols": part("n_symbols", "n_words"),
        "upper": part("n_upper", "n_letters"),
        "dup_lines": part("n_dup_lines", "n_lines"),
        "repeats": part("n_repeat_words", "n_words"),
        "stutter": part("n_stutter", "n_words"),
        "word_length": part("word_chars", "n_words"),
    }


def _blend(own: DataFrame, parent: DataFrame, keys: list[str], up: list[str]) -> DataFrame:
    """``own`` sketches plus their parents', scaled to PRIOR documents."""
    total = parent.groupBy(*up).agg(F.sum("n").alias("t"))
    scaled = parent.join(total, up).select(*up, "bucket", (F.lit(PRIOR) * F.col("n") / F.col("t")).alias("n"))
    handed = own.select(*keys).distinct().join(scaled, up).select(*keys, "bucket", "n")
    return own.select(*keys, "bucket", "n").unionByName(handed).groupBy(*keys, "bucket").agg(F.sum("n").alias("n"))


def sketches(measured: DataFrame, m: str, lang: str, source: str) -> DataFrame:
    """``lang, source, measure, bucket, n``: blended histograms of the documents that pass the base rule.

    Null languages and sources count as groups of their own (the empty name after a mark).
    """
    pairs = F.array(*(F.struct(F.lit(k).alias("measure"), v.alias("value")) for k, v in _measures(m).items()))
    own = (
        measured.where(f"{m}.n_words >= 20 and 100 * {m}.n_repeat_words <= 30 * {m}.n_words")
        .select(F.col(lang).alias("lang"), F.col(source).alias("source"), F.explode(pairs).alias("p"))
        .select("lang", "source", "p.measure", bucket(F.col("p.value")).alias("bucket"))
        .groupBy("lang", "source", "measure", "bucket")
        .agg(F.count("*").cast("double").alias("n"))
    )
    own = stored(own)
    langs = own.groupBy("lang", "measure", "bucket").agg(F.sum("n").alias("n"))
    whole = own.groupBy("measure", "bucket").agg(F.sum("n").alias("n"))
    langs = _blend(langs, whole, ["lang", "measure"], ["measure"])
    return _blend(own, langs, ["lang", "source", "measure"], ["lang", "measure"])


def bucket(value: Column) -> Column:
    return F.when(value < START, 0).otherwise(F.ceil(F.log(value / START) / F.log(F.lit(GROWTH))) + 1).cast("int")


def value_of(at: Column) -> Column:
    """A bucket's upper end."""
    return F.when(at == 0, 0.0).otherwise(F.lit(START) * F.pow(F.lit(GROWTH), at - 1))


def fences(sketch: DataFrame) -> DataFrame:
    """``lang, source`` and a column ``<measure>_at`` per measure: the highest value allowed."""
    by = Window.partitionBy("lang", "source", "measure")
    below = by.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    at = lambda q: F.min(F.when(F.col("below") >= q * F.col("t") * (1 - 1e-9), F.col("bucket")))
    spread = reduce(lambda c, k: c.when(F.col("measure") == k, SPREADS[k]), list(SPREADS)[1:], F.when(F.col("measure") == "symbols", SPREADS["symbols"]))
    quantiles = (
        sketch.select("*", F.sum("n").over(below).alias("below"), F.sum("n").over(by).alias("t"))
        .groupBy("lang", "source", "measure")
        .agg(value_of(at(0.5)).alias("mid"), value_of(at(0.75)).alias("high"))
    )
    limit = F.col("mid") + FENCE * F.greatest(F.col("high") - F.col("mid"), spread)
    return quantiles.groupBy("lang", "source").agg(*(F.max(F.when(F.col("measure") == k, limit)).alias(f"{k}_at") for k in SPREADS))


def judged(docs: DataFrame, keep_text: bool = True) -> tuple[DataFrame, str, str, str]:
    """``docs`` with a struct of counts and the flags base_failed and kept, and the three columns' names.

    ``docs`` needs doc_id, text, lang and source and may have any further columns, which stay.
    A null or empty text has no words and so fails the base rule. Repeated rows are each judged,
    alike. Without rows the result is empty. Ties at a fence are kept.
    """
    m, failed, kept, lang, source, fence = fresh(docs, "counts", "base_failed", "kept", "lang_key", "source_key", "limits")
    # a null key must meet itself in a join
    named = lambda c: F.when(F.col(c).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(c)))
    measured = docs.withColumns({m: counts(F.col("text")), lang: named("lang"), source: named("source")})
    measured = stored(measured.select(*(c for c in measured.columns if keep_text or c != "text")))
    limits = fences(sketches(measured, m, lang, source))
    # stored, so that the planner knows the size and chooses the join by it
    limits = stored(limits.select(F.col("lang").alias(lang), F.col("source").alias(source), F.struct(*(f"{k}_at" for k in SPREADS)).alias(fence)))
    base = F.expr(f"{m}.n_words < 20 or 100 * {m}.n_repeat_words > 30 * {m}.n_words")
    # a missing limit means that no document of the group passed the base rule
    inside = reduce(lambda a, b: a & b, (F.coalesce(v <= F.col(f"{fence}.{k}_at"), F.lit(True)) for k, v in _measures(m).items()))
    out = measured.join(limits, [lang, source], "left").withColumn(failed, base).withColumn(kept, ~base & inside)
    return out.drop(lang, source, fence), m, failed, kept


@stage
def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents that the rules keep, with their own columns."""
    out, _, _, kept = judged(docs)
    return out.where(F.col(kept)).select(*docs.columns)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, m, failed, kept = judged(documents(spark, sf_dir).select("doc_id", "text", "lang", "source"), keep_text=False)
    return out.select("doc_id", f"{m}.n_words", f"{m}.word_chars", f"{m}.n_symbols", f"{m}.n_dup_lines", f"{m}.n_repeat_words", F.col(failed).alias("base_failed"), F.col(kept).alias("kept"))


def _sql() -> str:
    word, blank = r"[^\x20\x09-\x0D]", "CASE WHEN {0} IS NULL THEN '' ELSE '=' || {0} END AS {0}"
    values = {
        "symbols": "n_symbols / greatest(n_words, 1)",
        "upper": "n_upper / greatest(n_letters, 1)",
        "dup_lines": "n_dup_lines / greatest(n_lines, 1)",
        "repeats": "n_repeat_words / greatest(n_words, 1)",
        "stutter": "n_stutter / greatest(n_words, 1)",
        "word_length": "word_chars / greatest(n_words, 1)",
    }
    measures = " UNION ALL ".join(f"SELECT r, lang, source, '{k}' AS measure, {v} AS v FROM counted WHERE NOT base_failed" for k, v in values.items())
    spreads = " ".join(f"WHEN '{k}' THEN {v}" for k, v in SPREADS.items())

    def blend(own: str, parent: str, keys: str, up: str) -> str:
        return f"""SELECT {keys}, bucket, sum(n) AS n FROM (
            SELECT {keys}, bucket, n FROM {own} UNION ALL
            SELECT {keys}, bucket, {PRIOR} * n / t FROM (SELECT DISTINCT {keys} FROM {own})
              JOIN {parent} USING ({up}) JOIN (SELECT {up}, sum(n) AS t FROM {parent} GROUP BY {up}) USING ({up})
          ) GROUP BY {keys}, bucket"""

    return f"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, {blank.format("lang")}, {blank.format("source")} FROM documents
), cut AS (
  SELECT *, regexp_extract_all(t, '{word}+') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{word}')) AS l FROM doc
), spot AS (
  SELECT r, i, array_to_string(w[i:i + 7], ' ') AS eight FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM cut)
), twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, eight) AS n FROM spot) WHERE n > 1
), covered AS (
  SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM (SELECT r, i, unnest(range(8)) AS k FROM twice) GROUP BY r
), counted AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM (
    SELECT r, doc_id, lang, source, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
      length(t) - length(translate(t, '{SYMBOLS}', '')) AS n_symbols, len(l) AS n_lines,
      len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
      length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper, length(regexp_replace(t, '[^A-Za-z]', '', 'g')) AS n_letters,
      len(list_filter(range(1, len(w)), lambda i: w[i] = w[i + 1])) AS n_stutter
    FROM cut LEFT JOIN covered USING (r))
), measured AS (
  SELECT *, CAST(CASE WHEN v < {START} THEN 0 ELSE ceil(ln(v / {START}) / ln({GROWTH})) + 1 END AS INTEGER) AS bucket FROM ({measures})
), own AS (
  SELECT lang, source, measure, bucket, CAST(count(*) AS DOUBLE) AS n FROM measured GROUP BY ALL
), of_lang AS (SELECT lang, measure, bucket, sum(n) AS n FROM own GROUP BY ALL
), whole AS (SELECT measure, bucket, sum(n) AS n FROM own GROUP BY ALL
), lang_sketch AS ({blend("of_lang", "whole", "lang, measure", "measure")}
), sketch AS ({blend("own", "lang_sketch", "lang, source, measure", "lang, measure")}
), running AS (
  SELECT *, sum(n) OVER (PARTITION BY lang, source, measure ORDER BY bucket) AS below, sum(n) OVER (PARTITION BY lang, source, measure) AS t FROM sketch
), quantile AS (
  SELECT lang, source, measure, min(bucket) FILTER (below >= 0.5 * t * (1 - 1e-9)) AS mid, min(bucket) FILTER (below >= 0.75 * t * (1 - 1e-9)) AS high
  FROM running GROUP BY ALL
), fence AS (
  SELECT lang, source, measure, m + {FENCE} * greatest(h - m, CASE measure {spreads} END) AS highest FROM (
    SELECT *, CASE WHEN mid = 0 THEN 0 ELSE {START} * pow({GROWTH}, mid - 1) END AS m, CASE WHEN high = 0 THEN 0 ELSE {START} * pow({GROWTH}, high - 1) END AS h
    FROM quantile)
), outside AS (SELECT DISTINCT r FROM measured JOIN fence USING (lang, source, measure) WHERE v > highest)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT base_failed AND r NOT IN (SELECT r FROM outside) AS kept
FROM counted
"""


OP2_SQL = _sql()
