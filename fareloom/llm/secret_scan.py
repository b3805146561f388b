"""Secret scans with an incremental blob ledger.

Every version of every path is content-addressed by the SHA-256 of its text. The ledger, a Parquet folder that only
grows, has one row for each (blob, rule, rule version) ever scanned, with the spans found. A scan reads only texts
whose blob has an unseen pair, each blob once however many paths hold it, and findings are joined back to all paths.

Cases: a null text counts as empty and has no findings. A null path is kept as a path of its own value. Repeated rows
stay repeated. An empty table gives an empty result. Columns other than the named ones are never looked at.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.llm.common import join_counted, let, shared_dir, stored, table


@dataclass(frozen=True)
class Rule:
    """A kind of secret: leftmost matches of `pattern`; those whose `group` is shorter than `least` are dropped."""

    kind: str
    version: int
    pattern: str
    group: int
    least: int


# The base kinds in their listed order.
RULES = (
    Rule("assign", 1, "((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    Rule("access", 1, "AKIA[A-Z0-9]+", 0, 20),
    # Runs are maximal, so asking for 24 characters in the pattern finds the same runs.
    Rule("hex", 1, "[0-9a-f]{24,}", 0, 24),
)
SPANS = "array<struct<start:int,end:int>>"
LEDGER = "blob binary, kind string, version int, spans array<struct<start:int,end:int>>"


def spans_of(text: Column, rule: Rule) -> Column:
    """array<struct<start,end>> of the rule's matches, in code points.

    Matches and the gaps between them alternate, so their lengths give every position.
    """
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    checked = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else whole
    gaps = F.split(text, rule.pattern, -1)
    parts = F.arrays_zip(
        F.transform(gaps, lambda x: F.length(x)).alias("gap"),
        F.transform(whole, lambda x: F.length(x)).alias("size"),
        F.transform(checked, lambda x: F.length(x)).alias("held"),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,held:int>>").alias("out"))

    def step(acc: Column, part: Column) -> Column:
        at = acc["at"] + part["gap"]
        end = at + part["size"]
        return F.when(part["size"].isNull(), acc).otherwise(
            F.struct(
                end.alias("at"),
                F.concat(acc["out"], F.array(F.struct(at.alias("start"), end.alias("end"), part["held"].alias("held")))).alias(
                    "out"
                ),
            )
        )

    found = F.aggregate(parts, start, step, lambda acc: acc["out"])
    kept = F.transform(
        F.filter(found, lambda x: x["held"] >= rule.least),
        lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")),
    )
    return F.when(text.rlike(rule.pattern), kept).otherwise(F.array().cast(SPANS))


def _ledger(spark: SparkSession, path: str) -> DataFrame:
    """What has been scanned so far; nothing where the folder has no run yet."""
    try:
        return spark.read.schema(LEDGER).parquet(f"{path}/run=*")
    except AnalysisException:
        return spark.createDataFrame([], LEDGER)


def scan_versions(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """versions (path, version, text) -> (path, version, blob, findings), one row for each row of versions.

    findings: array<struct<kind,start,end>> by start, then in the order of the rules. `ledger` is a folder that later
    scans are given again; a run that is repeated after a failure adds the same rows once more, which changes nothing.
    """
    spark = versions.sparkSession
    texts = versions.select("path", "version", F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.withColumn("blob", F.unhex(F.sha2(F.encode("text", "UTF-8"), 256)))
    ids = stored(texts.select("path", "version", "blob"), "versions")
    blobs = ids.groupBy("blob").agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct("path", "version")).alias("first")
    )
    current = F.array(*[F.lit(f"{r.kind}@{r.version}") for r in rules])
    seen = (
        _ledger(spark, ledger)
        .select("blob", F.concat_ws("@", "kind", "version").alias("pair"))
        .groupBy("blob")
        .agg(F.collect_set("pair").alias("seen"))
    )
    todo = (
        blobs.join(seen, "blob", "left")
        .withColumn("pairs", F.array_except(current, F.coalesce("seen", F.array().cast("array<string>"))))
        .filter(F.size("pairs") > 0)
        .select(F.col("blob").alias("todo_blob"), "first", "pairs")
    )
    # One text for each unseen blob: its first path. Repeated rows become one before and in the shuffle of the join, so
    # no task is hot. Structs are equal where their fields are equal or both null.
    once = (
        texts.select("blob", F.struct("path", "version").alias("first"), "text")
        .groupBy("blob", "first")
        .agg(F.first("text").alias("text"))
    )
    unseen = once.join(todo.hint("shuffle_hash"), (F.col("blob") == F.col("todo_blob")) & (once["first"] == todo["first"]))
    results = F.array(
        *[
            F.struct(
                F.lit(r.kind).alias("kind"),
                F.lit(r.version).alias("version"),
                F.array_contains("pairs", f"{r.kind}@{r.version}").alias("due"),
                F.when(F.array_contains("pairs", f"{r.kind}@{r.version}"), spans_of(F.col("text"), r)).alias("spans"),
            )
            for r in rules
        ]
    )
    (
        unseen.select("blob", F.explode(results).alias("r"))
        .filter("r.due")
        .select("blob", "r.kind", "r.version", "r.spans")
        .write.parquet(f"{ledger}/run={uuid.uuid4().hex}")
    )
    order = F.array_position(F.array(*[F.lit(r.kind) for r in rules]), F.col("kind"))
    is_current = F.array_contains(current, F.concat_ws("@", "kind", "version"))
    found = (
        _ledger(spark, ledger)
        .filter(is_current & (F.size("spans") > 0))
        .groupBy("blob", "kind", "version")
        .agg(F.first("spans").alias("spans"))
        .withColumn("order", order.cast("int"))
        .groupBy("blob")
        .agg(F.collect_list(F.struct("order", "kind", "spans")).alias("kinds"))
        .withColumn(
            "findings",
            F.sort_array(
                F.flatten(
                    F.transform(
                        "kinds",
                        lambda k: F.transform(
                            k["spans"],
                            lambda s: F.struct(
                                s["start"].alias("start"), k["order"].alias("order"), k["kind"].alias("kind"), s["end"].alias("end")
                            ),
                        ),
                    )
                )
            ),
        )
        .select("blob", F.transform("findings", lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"))).alias("findings"))
    )
    counted = stored(found.join(blobs.select("blob", "copies"), "blob"), "findings")
    joined = join_counted(ids, counted, "blob", "copies")
    return joined.withColumn("findings", F.coalesce("findings", F.array().cast("array<struct<kind:string,start:int,end:int>>")))


def redact(text: Column, findings: Column, mark: str = "[secret]") -> Column:
    """The text with every found span, overlaps merged, replaced by `mark`."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        fresh = x["start"] >= acc["at"]
        piece = F.concat(F.substring(text, acc["at"] + 1, x["start"] - acc["at"]), F.lit(mark))
        return F.struct(
            F.greatest(acc["at"], x["end"]).alias("at"),
            F.concat(acc["out"], F.when(fresh, piece).otherwise(F.lit(""))).alias("out"),
        )

    done = F.aggregate(findings, start, step)
    whole = let(done, lambda d: F.concat(d["out"], F.substring(text, d["at"] + 1, F.length(text))))
    return F.when(F.size(findings) > 0, whole).otherwise(text)


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, scanned through a fresh ledger: counts, digest and list of spans."""
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("path"), F.lit(0).alias("version"), "text"
    )
    found = scan_versions(docs, shared_dir(spark, "ledger"))
    listed = F.array_join(
        F.transform("findings", lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ","
    )

    def count(kind: str) -> Column:
        return F.size(F.filter("findings", lambda x: x["kind"] == kind)).cast("long")

    return found.select(
        F.col("path").alias("doc_id"),
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(listed, 256).alias("base_sha256"),
        listed.alias("spans"),
    )


def stage_secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every document stays, its secrets replaced by a mark."""
    key = F.struct(F.col("row.doc_id").alias("doc_id"), F.xxhash64("row.text").alias("hash"))
    packed = docs.select(F.struct("*").alias("row")).select("row", key.alias("key"), F.col("row.text").alias("text"))
    found = scan_versions(
        packed.select(F.col("key").alias("path"), F.lit(0).alias("version"), "text"), shared_dir(spark, "ledger")
    )
    hits = (
        found.filter(F.size("findings") > 0)
        .select(F.col("path").alias("key"), "findings")
        .groupBy("key")
        .agg(F.first("findings").alias("findings"))
    )
    marked = packed.join(hits.hint("shuffle_hash"), "key", "left")
    clean = F.when(F.col("findings").isNull(), F.col("row.text")).otherwise(redact(F.col("row.text"), F.col("findings")))
    return marked.select(*[clean.alias(c) if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])


# The same spans in DuckDB's SQL, from the patterns as they were given.
SQL_PATTERNS = {
    "assign": ("(?i:password|passwd|secret|token|api_?key)[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)", 1, 6),
    "access": ("AKIA[A-Z0-9]+", 0, 20),
    "hex": ("[0-9a-f]+", 0, 24),
}


def oracle_sql() -> str:
    """DuckDB SQL for op2."""
    parts = []
    for order, (kind, (pattern, group, least)) in enumerate(SQL_PATTERNS.items()):
        parts.append(
            f"SELECT doc_id, '{kind}' AS kind, {order} AS ord, i, "
            f"list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0) AS s, "
            f"length(m[i]) AS n, length(h[i]) AS held, {least} AS least FROM ("
            f"SELECT doc_id, m, h, g, unnest(range(1, len(m) + 1)) AS i FROM ("
            f"SELECT doc_id, regexp_extract_all(t, '{pattern}') AS m, regexp_extract_all(t, '{pattern}', {group}) AS h, "
            f"regexp_split_to_array(t, '{pattern}') AS g FROM docs))"
        )
    return f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
spans AS ({' UNION ALL '.join(parts)}),
kept AS (SELECT doc_id, kind, ord, s::BIGINT AS s, (s + n)::BIGINT AS e FROM spans WHERE held >= least),
lists AS (SELECT doc_id, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, ord) AS spans,
  count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
  count(*) FILTER (kind = 'hex') AS n_hex FROM kept GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs d LEFT JOIN lists USING (doc_id)"""
