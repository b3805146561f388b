"""Quality rules with cross-document line frequency.

Base rules look at one document: too few words, or too many words in repeated five-word windows. The cross-document
rule normalises and hashes lines, counts for each host (the source) in how many distinct documents a line stands, and
removes lines above the limit. The first document of a line keeps it, and equal texts count as one document, so a
group of copies is not its own boilerplate. A document that the removal leaves with too few words is rejected.

Cases: a null text is no words and fails. A null source is a host of its own. Repeated rows get equal verdicts. Ties
for a line's first document go to the smallest (doc_id, content hash); null ids come first. An empty table gives an
empty result. Very long texts are handled whole. Columns other than the named ones are never looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.llm.common import SPACE, join_counted, let, stored, table

#: A document needs so many words, before and after lines are removed.
LEAST_WORDS = 10
#: Percent of words that may lie in repeated windows.
MOST_REPEATED = 20
WINDOW = 5
#: A line in more distinct documents of its host than this is boilerplate.
LINE_LIMIT = 30
#: A document must keep at least this share of its words.
LEAST_SHARE = 0.2


def repeated_words(words: Column) -> Column:
    """How many words lie in WINDOW-word windows found twice or more in the list."""

    def covered(starts: Column) -> Column:
        reach = F.transform(
            starts, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, i + 1) - p, F.lit(WINDOW)))
        )
        return F.aggregate(reach, F.lit(0), lambda acc, x: acc + x)

    def starts_of(pairs: Column) -> Column:
        twice = F.filter(
            pairs,
            lambda p, i: F.coalesce(F.get(pairs, i - 1)["h"] == p["h"], F.lit(False))
            | F.coalesce(F.get(pairs, i + 1)["h"] == p["h"], F.lit(False)),
        )
        return F.sort_array(F.transform(twice, lambda p: p["at"]))

    def count(windows: Column) -> Column:
        pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
        found = let(pairs, lambda p: let(starts_of(p), covered))
        return F.when(F.size(F.array_distinct(windows)) < F.size(windows), found).otherwise(0)

    def windows_of(hashes: Column) -> Column:
        last = F.size(hashes) - WINDOW
        return F.transform(
            F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)])
        )

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(
        F.size(words) > WINDOW, let(hashed, lambda h: let(windows_of(h), count))
    ).otherwise(0).cast("long")


def normalised(line: Column) -> Column:
    """Lower case, runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(line), f"{SPACE}+", " "))


def measured(docs: DataFrame) -> DataFrame:
    """One row for each document: key, doc_id, content, the base measures, and its lines as (hash, words)."""
    text = F.coalesce("text", F.lit(""))
    keyed = docs.select(
        "doc_id",
        F.xxhash64("doc_id", "source", text).alias("key"),
        F.xxhash64(text).alias("content"),
        F.col("source").alias("host"),
        text.alias("text"),
    )

    def lines(host: Column) -> Column:
        norm = F.transform(F.split("text", "\n", -1), normalised)
        return F.transform(
            F.filter(norm, lambda x: x != ""),
            lambda x: F.struct(
                F.xxhash64(host, x).alias("line"), (F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))) + 1).alias("words")
            ),
        )

    raw = F.filter(F.split("text", "\n", -1), lambda x: x.rlike(f"[^{SPACE[1:-1]}]"))
    words = F.array_remove(F.split("text", f"{SPACE}+", -1), "")

    def measures(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            repeated_words(w).alias("n_repeat_words"),
        )

    return keyed.select(
        "key",
        "doc_id",
        "content",
        let(words, measures).alias("m"),
        F.length(F.regexp_replace("text", "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        let(raw, lambda r: F.size(r) - F.size(F.array_distinct(r))).cast("long").alias("n_dup_lines"),
        lines(F.col("host")).alias("lines"),
    ).select("key", "doc_id", "content", "m.*", "n_symbols", "n_dup_lines", "lines")


def frequent_lines(measures: DataFrame, limit: int = LINE_LIMIT) -> DataFrame:
    """(line, first_content, uses): lines in more than `limit` distinct documents of their host."""
    each = measures.select("content", "doc_id", F.explode(F.array_distinct("lines.line")).alias("line"))
    distinct = each.groupBy("line", "content").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n"), (F.count("doc_id") < F.count(F.lit(1))).alias("nulls"))
    rank = F.struct(F.when(F.col("nulls"), F.lit(None)).otherwise(F.col("doc_id")).alias("doc_id"), F.col("content"))
    return (
        distinct.groupBy("line")
        .agg(F.count(F.lit(1)).alias("documents"), F.min(rank)["content"].alias("first_content"), F.sum("n").alias("uses"))
        .filter(F.col("documents") > limit)
        .drop("documents")
    )


def removals(measures: DataFrame, frequent: DataFrame) -> DataFrame:
    """(key, line, words): the lines to remove from each document, once for each time they stand in it."""
    each = measures.select("key", "content", F.explode("lines").alias("l")).select("key", "content", "l.line", "l.words")
    hit = join_counted(each, frequent, "line", "uses", "inner")
    return hit.filter(F.col("content") != F.col("first_content")).select("key", "line", "words")


def judged(measures: DataFrame, removed: DataFrame) -> DataFrame:
    """measures with base_failed, removed_words and kept."""
    lost = removed.groupBy("key").agg(F.sum("words").cast("long").alias("lost"), F.count(F.lit(1)).alias("rows"))
    repeats = measures.groupBy("key").agg(F.count(F.lit(1)).alias("same"))
    # Equal rows share a key; what all of them lose is divided among them.
    lost = lost.join(repeats, "key").select("key", F.expr("lost div same").alias("removed_words"))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    left = F.col("n_words") - F.col("removed_words")
    depleted = (F.col("removed_words") > 0) & ((left < LEAST_WORDS) | (left < LEAST_SHARE * F.col("n_words")))
    return (
        measures.join(lost, "key", "left")
        .na.fill(0, ["removed_words"])
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & ~depleted)
    )


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document."""
    measures = stored(measured(table(spark, sf_dir, "documents")), "measures")
    frequent = stored(frequent_lines(measures), "frequent")
    out = judged(measures.drop("content"), removals(measures, frequent))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "removed_words"
    )


def stage_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: rejected documents go, the others lose their boilerplate lines."""
    measures = stored(measured(docs), "measures")
    frequent = stored(frequent_lines(measures), "frequent")
    removed = stored(removals(measures, frequent), "removals")
    verdict = judged(measures.drop("content"), removed).filter("kept").groupBy("key").agg(F.lit(1).alias("kept"))
    cut = removed.groupBy("key").agg(F.collect_set("line").alias("cut"))
    plan = verdict.join(cut, "key", "left")
    packed = docs.select(
        F.struct("*").alias("row"),
        F.xxhash64("doc_id", "source", F.coalesce("text", F.lit(""))).alias("key"),
    )
    stays = packed.join(plan.hint("shuffle_hash"), "key")
    host = F.col("row.source")
    lines = F.filter(
        F.split("row.text", "\n", -1), lambda x: ~F.array_contains("cut", F.xxhash64(host, normalised(x)))
    )
    clean = F.when(F.col("cut").isNull(), F.col("row.text")).otherwise(F.array_join(lines, "\n"))
    return stays.select(*[clean.alias(c) if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])


def oracle_sql() -> str:
    """DuckDB SQL for op9, by sets of lines and window starts instead of arrays."""
    ws = "[\\x20\\x09-\\x0D]+"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, source, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS words FROM d),
win AS (SELECT r, i, words[i:i+{WINDOW - 1}] AS g FROM (SELECT r, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM w)),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM win) WHERE c > 1),
cov AS (SELECT r, count(DISTINCT i + k)::BIGINT AS n FROM rep, range(0, {WINDOW}) AS x(k) GROUP BY r),
lines AS (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d),
dup AS (SELECT r, (count(*) - count(DISTINCT line))::BIGINT AS n FROM lines WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY r),
norm AS (SELECT r, trim(regexp_replace(lower(line), '{ws}', ' ', 'g')) AS line FROM lines),
own AS (SELECT r, doc_id, source, t, line, len(string_split(line, ' ')) AS words FROM norm JOIN d USING (r) WHERE line <> ''),
freq AS (SELECT source, line, arg_min(t, doc_id) AS first_t FROM own GROUP BY source, line HAVING count(DISTINCT t) > {LINE_LIMIT}),
lost AS (SELECT r, sum(words)::BIGINT AS n FROM own JOIN freq ON own.source IS NOT DISTINCT FROM freq.source AND own.line = freq.line
  WHERE t <> first_t GROUP BY r),
m AS (SELECT r, doc_id, len(words)::BIGINT AS n_words,
  length(array_to_string(words, ''))::BIGINT AS word_chars,
  len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols FROM w),
j AS (SELECT doc_id, n_words, word_chars, n_symbols, coalesce(dup.n, 0) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words,
  coalesce(lost.n, 0) AS removed_words FROM m LEFT JOIN dup USING (r) LEFT JOIN cov USING (r) LEFT JOIN lost USING (r))
SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed,
  NOT (n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words) AND NOT (removed_words > 0 AND
    (n_words - removed_words < {LEAST_WORDS} OR n_words - removed_words < {LEAST_SHARE} * n_words)) AS kept
FROM j"""
