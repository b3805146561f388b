"""URL filters: allow and block rules, and a character language-model ratio for what no rule decides.

Two variable-order Markov models over characters are learned, one from the distinct URLs that a rule allows and one from
those that a rule blocks. A character's probability starts at a uniform one and is mixed, for contexts of 0, 1, ...
ORDER characters, with what followed that context in training, by Witten-Bell weights; a context that a class has not
seen MIN_SEEN times leaves the shorter one's estimate, so the order varies with what is known. A URL's score is the
difference of its two log-likelihoods over its number of characters and the end. The limit is calibrated on labelled
URLs that neither model has read.

Everything is DataFrame functions. The models are tables, as large as the corpus makes them, and are joined, never
broadcast: a level of them joins the level below on a gram's last characters, which as many rows share as there are
characters. Only grams that hold a large share of all positions are broadcast, at most 256 of them. The joins say so by
a hint, since Spark goes by the bytes of a table's files, and there rare grams, whose counts are nearly all equal, take
a small part of the bytes that they take on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fareloom.llm.common import join_counted, stored, table

ALLOW, BLOCK = "allow", "block"
#: Longest context in characters.
ORDER = 5
#: A context of one or more characters counts for a class once the class has it this often.
MIN_SEEN = 2
#: The uniform start: one of all code points.
ALPHABET = 1_114_112
#: Log ratios are kept as whole parts of this, so that their sums do not depend on order.
SCALE = 1 << 20
#: Labelled URLs whose MD5 starts with one of these digits calibrate and are not learned from.
HELD_OUT = "0123"
#: Steps of the limit for one nat a character, and the largest limit.
BINS, FARTHEST = 256, 16
#: Begin and end of a URL for the models, and characters handled as one piece.
BEGIN, END, PIECE = "\u0002", "\u0003", 256
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


class Rule(NamedTuple):
    """Fits `host` and its subdomains where the path starts with `path`."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("com", "/", ALLOW),
    Rule("example.com", "/en/", BLOCK),
    Rule("www.example.com", "/en/", ALLOW),
    Rule("net", "/es/", BLOCK),
    Rule("net", "/fr/", BLOCK),
)


def host_of(url: Column) -> Column:
    """What stands after the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty without `://`."""
    return F.translate(F.regexp_extract(_after_scheme(url), "^[^/?#]*+", 0), UPPER, UPPER.lower())


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end; empty without `://`."""
    return F.regexp_extract(_after_scheme(url), "^[^/?#]*+([^?#]*+)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule], field: str = "name") -> Column:
    """A field of the longest rule that fits, else null. The rules are a list that the caller writes."""
    found = None
    for rule in sorted(rules, key=lambda r: (-len(r.name), -len(r.host), r)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = (F if found is None else found).when(fits, F.lit(getattr(rule, field)))
    return F.lit(None).cast("string") if found is None else found


def grams(urls: DataFrame, order: int = ORDER) -> DataFrame:
    """urls (url, ...) -> its other columns and `gram`: each character or end with up to `order` characters before it.

    A long URL is cut into pieces first, which begin with the last characters of the piece before, so that work grows
    with the length.
    """
    kept = [c for c in urls.columns if c != "url"]
    framed = F.concat(F.lit(BEGIN), "url", F.lit(END))
    pieces = urls.select(*kept, F.regexp_extract_all(framed, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0)).alias("_pieces"))
    before = F.when(F.col("_i") > 0, F.right(F.element_at("_pieces", F.col("_i")), F.lit(order))).otherwise(F.lit(""))
    joined = (
        pieces.select(*kept, "_pieces", F.posexplode("_pieces").alias("_i", "_piece"))
        .withColumn("_before", before)
        .select(
            *kept,
            F.concat("_before", "_piece").alias("_text"),
            F.when(F.col("_i") > 0, F.length("_before")).otherwise(F.lit(1)).alias("_known"),
        )
    )
    each = joined.select(*kept, "_text", F.explode(F.sequence(F.col("_known") + 1, F.length("_text"))).alias("_at"))
    return each.select(
        *kept, F.substring("_text", F.greatest(F.lit(1), F.col("_at") - order), F.least("_at", F.lit(order + 1))).alias("gram")
    )


def log_ratios(counted: DataFrame, order: int = ORDER) -> DataFrame:
    """counted (gram, accepted, rejected, judged: how often each holds it) -> (gram, judged, ratio) where judged > 0.

    ratio: the difference of the log-probabilities of a gram's last character after the others, in parts of SCALE.
    """
    spread = counted.select("*", F.explode(F.sequence(F.lit(1), F.length("gram"))).alias("_n"))
    suffixes = spread.groupBy(F.expr("right(gram, _n)").alias("gram"), F.col("_n").alias("n")).agg(
        F.sum("accepted").alias("accepted"),
        F.sum("rejected").alias("rejected"),
        F.sum(F.when(F.col("_n") == F.length("gram"), F.col("judged")).otherwise(F.lit(0))).alias("judged"),
    )
    # As many rows share a context as characters followed it, whatever the size of the corpus.
    context = Window.partitionBy("n", F.expr("left(gram, n - 1)"))
    sized = stored(
        suffixes.select(
            "*",
            *[F.sum(c).over(context).alias(f"all_{c}") for c in ("accepted", "rejected")],
            *[F.count_if(F.col(c) > 0).over(context).alias(f"kinds_{c}") for c in ("accepted", "rejected")],
        ),
        "url-counts",
    )
    levels, below = [], None
    for n in range(1, order + 2):
        level = sized.filter(F.col("n") == n)
        if below is None:
            level = level.withColumns({f"low_{c}": F.lit(1.0 / ALPHABET) for c in ("accepted", "rejected")})
        else:
            lower = below.select(
                F.col("gram").alias("_lower"), F.col("p_accepted").alias("low_accepted"), F.col("p_rejected").alias("low_rejected")
            )
            level = level.withColumn("_lower", F.expr("right(gram, n - 1)")).join(lower.hint("merge"), "_lower").drop("_lower")
        below = stored(level.withColumns({f"p_{c}": _mixed(c, n) for c in ("accepted", "rejected")}), f"url-level-{n}")
        levels.append(below)
    ratio = F.round((F.ln("p_accepted") - F.ln("p_rejected")) * SCALE).cast("long")
    found = None
    for level in levels:
        part = level.filter("judged > 0").select("gram", "judged", ratio.alias("ratio"))
        found = part if found is None else found.unionAll(part)
    return found


def _mixed(side: str, n: int) -> Column:
    """Witten-Bell: what followed the context, and the shorter context's estimate by the number of kinds that followed."""
    kinds, total, low = F.col(f"kinds_{side}"), F.col(f"all_{side}"), F.col(f"low_{side}")
    known = total >= (MIN_SEEN if n > 1 else 1)
    return F.when(known, (F.col(side) + kinds * low) / (total + kinds)).otherwise(low)


def scores(urls: DataFrame, order: int = ORDER) -> DataFrame:
    """urls (u, url, part), one row per URL -> (u, score) of those not learned from.

    part: accepted and rejected are learned from; any other is scored.
    """
    learned = F.col("part").isin("accepted", "rejected")
    counted = stored(
        grams(urls.select("url", "part"), order).groupBy("gram").agg(
            F.count_if(F.col("part") == "accepted").alias("accepted"),
            F.count_if(F.col("part") == "rejected").alias("rejected"),
            F.count_if(~learned).alias("judged"),
        ),
        "url-grams",
    )
    ratios = stored(log_ratios(counted, order), "url-ratios")
    placed = grams(urls.filter(~learned).select("u", "url"), order)
    return (
        join_counted(placed, ratios, "gram", "judged", "inner", merged=True)
        .groupBy("u")
        .agg((F.sum("ratio") / F.count(F.lit(1)) / SCALE).alias("score"))
    )


def calibrated_limit(scored: DataFrame) -> float:
    """The limit that tells held-out accepted URLs (at or above) from rejected ones best, each side counting the same.

    scored (part, score). Of equally good limits that nearest to zero is taken, of two such the lower; zero if a side is
    empty. The limits are steps of 1 / BINS between -FARTHEST and FARTHEST, so the last table has 8,193 rows at most.
    """
    far = FARTHEST * BINS
    bins = (
        scored.groupBy(F.least(F.greatest(F.floor(F.col("score") * BINS), F.lit(-far)), F.lit(far)).alias("bin"))
        .agg(F.count_if(F.col("part") == "held_accepted").alias("a"), F.count_if(F.col("part") == "held_rejected").alias("r"))
        .filter("a + r > 0")
    )
    whole, below = Window.orderBy(F.lit(1)), Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    # Any step above the bin before and up to this one parts them alike.
    step = F.greatest(F.least(F.lit(0), "bin"), F.coalesce(F.max("bin").over(below) + 1, F.lit(-far)))
    told = bins.select(
        step.alias("step"),
        F.coalesce(F.sum("r").over(below), F.lit(0)).alias("blocked"),
        F.coalesce(F.sum("a").over(below), F.lit(0)).alias("lost"),
        F.sum("a").over(whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("a"),
        F.sum("r").over(whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("r"),
    ).filter("a > 0 AND r > 0")
    # Whole numbers: blocked / r - lost / a, times a * r.
    gain = F.col("blocked") * F.col("a") - F.col("lost") * F.col("r")
    best = told.orderBy(gain.desc(), F.abs("step"), "step").select("step").first()
    return best.step / BINS if best else 0.0


def filter_urls(urls: DataFrame, rules: Sequence[Rule] = RULES, order: int = ORDER) -> DataFrame:
    """urls (url) -> one row per distinct URL: url, copies, host, path, rule, score, limit, verdict.

    A null URL counts as empty. Where a rule fits, it decides and score is null. Otherwise the models do: allow at the
    limit or above. Without a single accepted or rejected URL to learn from both models are the same, the score is that
    of the other's ignorance, and the limit is zero. A hot URL is one row: copies do not weigh in the models.
    """
    distinct = urls.select(F.coalesce("url", F.lit("")).alias("url")).groupBy("url").agg(F.count(F.lit(1)).alias("copies"))
    told = distinct.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    told = told.withColumns({
        "rule": rule_of(F.col("host"), F.col("path"), rules),
        "_ruled": rule_of(F.col("host"), F.col("path"), rules, "verdict"),
    })
    label = F.when(F.col("_ruled") == ALLOW, "accepted").when(F.col("_ruled") == BLOCK, "rejected")
    held = F.substring(F.md5("url"), 1, 1).isin(*HELD_OUT)
    part = F.when(label.isNull(), "open").when(held, F.concat(F.lit("held_"), label)).otherwise(label)
    told = stored(told.withColumns({"part": part, "u": F.monotonically_increasing_id()}), "urls")
    scored = stored(scores(told.select("u", "url", "part"), order), "url-scores")
    named = told.join(scored.hint("merge"), "u", "left")
    limit = calibrated_limit(named.filter(F.col("part").startswith("held_")).select("part", "score"))
    open_score = F.when(F.col("_ruled").isNull(), F.col("score"))
    by_model = F.when(open_score < limit, BLOCK).otherwise(ALLOW)
    return named.select(
        "url", "copies", "host", "path", "rule", open_score.alias("score"), F.lit(limit).alias("limit"),
        F.coalesce("_ruled", by_model).alias("verdict"),
    )


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL judged; pages that share a URL share its verdict."""
    pages = table(spark, sf_dir, "pages").select("page_id", F.coalesce("url", F.lit("")).alias("url"))
    judged = stored(filter_urls(pages), "url-verdicts")
    joined = join_counted(pages, judged, "url", "copies", "inner", merged=True)
    return joined.select(F.col("page_id").cast("long"), "host", "path", "rule", "verdict")


def oracle_sql() -> str:
    """DuckDB SQL for op13, models and limit included."""
    ranked = sorted(RULES, key=lambda r: (-len(r.name), -len(r.host), r))
    fits = {r: f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')" for r in ranked}
    rule = "CASE " + " ".join(f"WHEN {fits[r]} THEN '{r.name}'" for r in ranked) + " END"
    ruled = "CASE " + " ".join(f"WHEN {fits[r]} THEN '{r.verdict}'" for r in ranked) + " END"
    after = "CASE WHEN instr(url, '://') > 0 THEN substring(url, instr(url, '://') + 3) ELSE '' END"
    far = FARTHEST * BINS
    levels, low = [], None
    for n in range(1, ORDER + 2):
        lows = {c: f"{1.0 / ALPHABET!r}::DOUBLE" if low is None else f"b.p_{c}" for c in ("accepted", "rejected")}
        mixed = ", ".join(
            f"CASE WHEN s.all_{c} >= {MIN_SEEN if n > 1 else 1}"
            f" THEN (s.{c} + s.kinds_{c} * {lows[c]}) / (s.all_{c} + s.kinds_{c}) ELSE {lows[c]} END AS p_{c}"
            for c in lows
        )
        source = "sized s" if low is None else f"sized s JOIN {low} b ON b.gram = substring(s.gram, 2)"
        low = f"level{n}"
        levels.append(f"{low} AS (SELECT s.gram, s.judged, {mixed} FROM {source} WHERE s.n = {n})")
    union = " UNION ALL ".join(f"SELECT * FROM level{n}" for n in range(1, ORDER + 2))
    return f"""
WITH given AS (SELECT page_id::BIGINT AS page_id, coalesce(url, '') AS url FROM pages),
parts AS (SELECT DISTINCT url, {after} AS rest FROM given),
hosts AS (SELECT url, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{UPPER.lower()}') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
ruled AS (SELECT url, host, path, {rule} AS rule, {ruled} AS ruled FROM hosts),
told AS (SELECT *, CASE WHEN ruled IS NULL THEN 'open' ELSE
  CASE WHEN md5(url)[1] IN ({", ".join(f"'{d}'" for d in HELD_OUT)}) THEN 'held_' ELSE '' END
  || CASE ruled WHEN '{ALLOW}' THEN 'accepted' ELSE 'rejected' END END AS part, '{BEGIN}' || url || '{END}' AS framed FROM ruled),
places AS (SELECT url, part, framed, unnest(generate_series(2, length(framed))) AS j FROM told),
grams AS (SELECT url, part, substring(framed, greatest(1, j - {ORDER}), least(j, {ORDER + 1})) AS gram FROM places),
counted AS (SELECT gram, count(*) FILTER (part = 'accepted') AS accepted, count(*) FILTER (part = 'rejected') AS rejected,
  count(*) FILTER (part NOT IN ('accepted', 'rejected')) AS judged FROM grams GROUP BY gram),
spread AS (SELECT *, unnest(generate_series(1, length(gram))) AS n FROM counted),
suffixes AS (SELECT right(gram, n) AS suffix, n, sum(accepted) AS accepted, sum(rejected) AS rejected,
  sum(CASE WHEN n = length(gram) THEN judged ELSE 0 END) AS judged FROM spread GROUP BY 1, 2),
sized AS (SELECT suffix AS gram, n, accepted::DOUBLE AS accepted, rejected::DOUBLE AS rejected, judged,
  sum(accepted) OVER c AS all_accepted, sum(rejected) OVER c AS all_rejected,
  count(*) FILTER (accepted > 0) OVER c AS kinds_accepted, count(*) FILTER (rejected > 0) OVER c AS kinds_rejected
  FROM suffixes WINDOW c AS (PARTITION BY n, left(suffix, n - 1))),
{", ".join(levels)},
ratios AS (SELECT gram, round((ln(p_accepted) - ln(p_rejected)) * {SCALE})::BIGINT AS ratio FROM ({union}) WHERE judged > 0),
scored AS (SELECT url, part, sum(ratio)::DOUBLE / count(*) / {SCALE} AS score FROM grams JOIN ratios USING (gram)
  WHERE part NOT IN ('accepted', 'rejected') GROUP BY url, part),
bins AS (SELECT least(greatest(floor(score * {BINS}), -{far}), {far}) AS bin, count(*) FILTER (part = 'held_accepted') AS a,
  count(*) FILTER (part = 'held_rejected') AS r FROM scored WHERE part <> 'open' GROUP BY 1),
gains AS (SELECT greatest(least(0, bin), coalesce(max(bin) OVER b + 1, -{far})) AS step, coalesce(sum(r) OVER b, 0) * sum(a) OVER () - coalesce(sum(a) OVER b, 0) * sum(r) OVER () AS gain,
  sum(a) OVER () AS a, sum(r) OVER () AS r FROM bins WINDOW b AS (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
chosen AS (SELECT coalesce((SELECT step / {BINS} FROM gains WHERE a > 0 AND r > 0 ORDER BY gain DESC, abs(step), step LIMIT 1), 0) AS limit_at)
SELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN score < limit_at THEN '{BLOCK}' ELSE '{ALLOW}' END) AS verdict
FROM given JOIN told USING (url) LEFT JOIN scored USING (url) CROSS JOIN chosen"""
