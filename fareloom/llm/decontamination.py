"""Benchmark decontamination with a BM25 index of test items and block-max WAND.

The inverted index holds the test items, a small collection; every passage of every training document is a query. A
posting's weight is its BM25 share: what the term adds to the item's score, divided by the score of the item for
itself, so one threshold serves all items. Terms are numbered by their list maximum. For a passage the terms of
smallest maximum are set aside while their sum stays below half the threshold; postings of the others are added up, and
an item goes on only if what it has plus what was set aside can reach the threshold. Then the maxima of its block, and
last the postings themselves, decide. Nothing above the threshold is lost. Passages overlap by half and are as long as
two segments of an item, so that each segment lies in one whole.

A retrieved item counts only if enough of its question's and of its answer's word n-grams stand near the passage.

Items are indexed by text: distinct (item, question, answer) rows are numbered, statistics and weights are those of
texts, and a text's number turns back into its item's id once it is verified. So repeated rows weigh nothing, and an id
with several texts is found by any of them.

Texts are split over index shards of SHARD_POSTINGS postings on average (a text's segments stay together). Each
shard is one broadcast of bounded size, and the documents pass through one shard after the other.

Cases: null or empty documents match nothing; null or empty items match nothing. Repeated rows and equal ids give one
row for each (doc_id, item_id), with the best score. Items with equal texts are all reported. An empty table gives an
empty result. Columns other than the named ones are never looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.llm.common import SPACE, by_value, stored, table

by_value(__name__)

K1, B = 1.2, 0.75
#: Share of an item's own BM25 score that a passage must reach.
THRESHOLD = 0.6
#: Word n-grams, and the share of the question's and the answer's that must stand near the passage.
GRAM, OVERLAP = 3, 0.6
#: Terms in a segment of an item, and words between the starts of passages.
SEGMENT = 64
#: Postings in an index shard, at most (but for a single item), and entries of its table of block maxima.
SHARD_POSTINGS = 2_000_000
BLOCK_CELLS = 4_000_000
#: Words of documents that are worked on together, and cells of the score table.
CHUNK_WORDS = 400_000
SCORE_CELLS = 2_000_000

PUNCTUATION = bytes.maketrans(bytes(c for c in range(128) if not chr(c).isalnum()), b" " * sum(not chr(c).isalnum() for c in range(128)))


def terms(text: str | None) -> list[bytes]:
    """Lower-case words; ASCII punctuation separates them."""
    return (text or "").lower().encode().translate(PUNCTUATION).split()


def grams(words: list[bytes]) -> set[bytes]:
    """Word n-grams; of fewer words the whole."""
    n = min(GRAM, len(words))
    return {b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Items -> one row for each segment and term."""
    for batch in batches:
        rows: dict[str, list] = {"item": [], "segment": [], "term": [], "tf": [], "length": []}
        for item, q, a in zip(batch.column("item"), batch.column("question"), batch.column("answer"), strict=True):
            words = terms(q.as_py()) + terms(a.as_py())
            parts = -(-len(words) // SEGMENT)
            for part in range(parts):
                own = words[part * len(words) // parts : (part + 1) * len(words) // parts]
                for term in dict.fromkeys(own):
                    rows["item"].append(item)
                    rows["segment"].append(part)
                    rows["term"].append(term)
                    rows["tf"].append(own.count(term))
                    rows["length"].append(len(own))
        yield pa.RecordBatch.from_pydict(
            {
                "item": pa.array([x.as_py() for x in rows["item"]], pa.int64()),
                "segment": pa.array(rows["segment"], pa.int32()),
                "term": pa.array(rows["term"], pa.binary()),
                "tf": pa.array(rows["tf"], pa.int32()),
                "length": pa.array(rows["length"], pa.int32()),
            }
        )


def postings(items: DataFrame) -> DataFrame:
    """items (item, question, answer) -> item, segment, term, weight; the statistics are those of all items."""
    raw = stored(
        items.select("item", "question", "answer").mapInArrow(
            _segments, "item long, segment int, term binary, tf int, length int"
        ),
        "segment-terms",
    )
    sizes = raw.select("item", "segment", "length").distinct()
    whole = sizes.agg(F.count(F.lit(1)).alias("n"), F.avg("length").alias("mean")).first()
    counts = raw.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log(1 + (whole["n"] - F.col("df") + 0.5) / (F.col("df") + 0.5))
    gain = F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("length") / (whole["mean"] or 1.0)))
    scored = raw.join(counts, "term").withColumn("gain", idf * gain)
    own = scored.groupBy("item", "segment").agg(F.sum("gain").alias("own"))
    return scored.join(own, ["item", "segment"]).select("item", "segment", "term", (F.col("gain") / F.col("own")).alias("weight"))


def spread(starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every range its number, and all its positions."""
    total = int(counts.sum())
    number = np.repeat(np.arange(len(counts)), counts)
    first = np.cumsum(counts) - counts
    return number, np.arange(total) - np.repeat(first - starts, counts)


class ItemIndex:
    """A shard of the inverted index, with list and block maxima."""

    def __init__(self, rows: list, texts: list):
        """rows: (item, segment, term, weight); texts: (item, question, answer)."""
        names = sorted({(r["item"], r["segment"]) for r in rows})
        numbers = {n: i for i, n in enumerate(names)}
        self.item = [n[0] for n in names]
        self.size = len(names)
        weight = np.array([r["weight"] for r in rows])
        segment = np.array([numbers[r["item"], r["segment"]] for r in rows], np.int64)
        by_term: dict[bytes, int] = {}
        term = np.array([by_term.setdefault(bytes(r["term"]), len(by_term)) for r in rows], np.int64)
        most = np.zeros(len(by_term))
        np.maximum.at(most, term, weight)
        rank = np.empty(len(most), np.int64)
        rank[np.argsort(most, kind="stable")] = np.arange(len(most))
        self.terms = {t: int(rank[i]) for t, i in by_term.items()}  # numbered by list maximum
        self.most = np.sort(most)
        term = rank[term]
        order = np.lexsort((segment, term))
        self.segment, self.weight, term = segment[order], weight[order], term[order]
        self.first = np.searchsorted(term, np.arange(len(most) + 1))
        self.keys = term * self.size + self.segment
        self.block = max(1, -(-self.size * len(most) // BLOCK_CELLS), 16)
        self.block_most = np.zeros((len(most), -(-self.size // self.block)), np.float32)
        np.maximum.at(self.block_most, (term, self.segment // self.block), self.weight)
        self.block_most = np.nextafter(self.block_most, np.float32(2))  # rounding never lowers a bound
        self.grams = {t["item"]: (grams(terms(t["question"])), grams(terms(t["answer"]))) for t in texts}
        self.reach = {t["item"]: len(terms(t["question"])) + len(terms(t["answer"])) for t in texts}

    def retrieve(self, passage: np.ndarray, term: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(passage, segment, score) with a score of THRESHOLD or more.

        passage, term: the distinct terms of passages 0..count-1, sorted; terms are in the order of their maxima.
        """
        bound = self.most[term]
        run = np.cumsum(bound)
        first = np.searchsorted(passage, np.arange(count + 1))
        before = np.concatenate([[0.0], run])[first[:-1]]
        upto = run - before[passage]
        aside = upto < THRESHOLD / 2
        rest = np.bincount(passage[aside], bound[aside], count)
        out = []
        step = max(1, SCORE_CELLS // self.size)
        slack = 1e-9
        for lo in range(0, count, step):
            hi = min(count, lo + step)
            mine = slice(first[lo], first[hi])
            rows = np.flatnonzero(~aside[mine]) + first[lo]
            number, at = spread(self.first[term[rows]], self.first[term[rows] + 1] - self.first[term[rows]])
            cells = (passage[rows[number]] - lo) * self.size + self.segment[at]
            score = np.bincount(cells, self.weight[at], (hi - lo) * self.size).reshape(hi - lo, self.size)
            p, s = np.nonzero((score > 0) & (score + rest[lo:hi, None] >= THRESHOLD - slack))
            if not len(p):
                continue
            have = score[p, s]
            # What was set aside: first the maxima of the segment's block, then the postings.
            asides = np.bincount(passage[mine][aside[mine]] - lo, minlength=hi - lo)
            number, at = spread(first[lo:hi][p], asides[p])  # terms set aside come first in a passage
            limit = have + np.bincount(number, self.block_most[term[at], s[number] // self.block], len(p))
            live = limit >= THRESHOLD - slack
            p, s, have = p[live], s[live], have[live]
            number, at = spread(first[lo:hi][p], asides[p])
            key = term[at] * self.size + s[number]
            place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            exact = have + np.bincount(number, np.where(self.keys[place] == key, self.weight[place], 0.0), len(p))
            full = exact >= THRESHOLD - slack
            out.append((p[full] + lo, s[full], exact[full]))
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def matches(self, docs: list[list[bytes]]) -> Iterator[tuple[int, int, float, float, float]]:
        """(document, item, score, question overlap, answer overlap) for passages that pass both tests."""
        sizes = np.array([len(d) for d in docs], np.int64)
        windows = np.maximum(1, -(-sizes // SEGMENT) - 1)
        base = np.cumsum(windows) - windows
        tid = np.fromiter(
            (x for d in docs for x in map(self.terms.get, d, repeat(-1))), np.int64, int(sizes.sum())
        )
        doc, at = spread(np.zeros(len(docs), np.int64), sizes)
        hit = tid >= 0
        tid, doc, part = tid[hit], doc[hit], at[hit] // SEGMENT
        upper = base[doc] + np.minimum(part, windows[doc] - 1)
        lower = base[doc] + np.clip(part - 1, 0, windows[doc] - 1)
        width = len(self.most)
        keys = np.unique(np.concatenate([upper * width + tid, lower * width + tid]))
        passage, segment, score = self.retrieve(keys // width, keys % width, int(windows.sum()))
        owner = np.searchsorted(base, passage, side="right") - 1
        for p, s, value, d in zip(passage, segment, score, owner, strict=True):
            item = self.item[s]
            start = (p - base[d]) * SEGMENT
            near = grams(docs[d][max(0, start - self.reach[item]) : start + 2 * SEGMENT + self.reach[item]])
            shares = [len(g & near) / len(g) if g else 0.0 for g in self.grams[item]]
            if min(shares) >= OVERLAP:
                yield int(d), int(item), float(value), *shares


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """docs (key, text), items (item, question, answer) -> key, item, score, question_overlap, answer_overlap."""
    spark = docs.sparkSession
    # Stored, so that a text's number is the same wherever it is read.
    distinct = items.select("item", "question", "answer").distinct()
    numbered = stored(distinct.withColumn("number", F.monotonically_increasing_id()), "texts")
    index = stored(postings(numbered.select(F.col("number").alias("item"), "question", "answer")), "postings")
    kind = docs.schema["key"].dataType.simpleString()
    schema = f"key {kind}, item long, score double, question_overlap double, answer_overlap double"
    shards = -(-index.count() // SHARD_POSTINGS)
    found = None
    for shard in range(shards):
        mine = lambda number: F.pmod(F.xxhash64(number), F.lit(shards)) == shard  # noqa: B023, E731
        texts = numbered.filter(mine("number")).filter("item IS NOT NULL").toArrow().to_pylist()
        ids = {t["number"]: t["item"] for t in texts}
        rows = [r for r in index.filter(mine("item")).toArrow().to_pylist() if r["item"] in ids]  # SHARD_POSTINGS on average
        if not rows:
            continue
        built = ItemIndex(rows, [{**t, "item": t["number"]} for t in texts])
        sent = spark.sparkContext.broadcast((vars(built), ids))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = ItemIndex.__new__(ItemIndex)
            values, ids = sent.value
            vars(index).update(values)
            for batch in batches:
                keys, texts = batch.column("key"), batch.column("text")
                at = 0
                while at < len(keys):
                    docs, words = [], 0
                    while at + len(docs) < len(keys) and (not docs or words < CHUNK_WORDS):
                        docs.append(terms(texts[at + len(docs)].as_py()))
                        words += len(docs[-1])
                    hits = list(index.matches(docs))
                    if hits:
                        d, number, *rest = map(list, zip(*hits, strict=True))
                        yield pa.RecordBatch.from_arrays(
                            [keys.take(pa.array([at + x for x in d])), pa.array([ids[n] for n in number], pa.int64()), *map(pa.array, rest)],
                            ["key", "item", "score", "question_overlap", "answer_overlap"],
                        )
                    at += len(docs)

        part = docs.select("key", "text").mapInArrow(run, schema)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], schema.replace(f"key {kind}", f"key {kind}"))
    measures = ("score", "question_overlap", "answer_overlap")
    best = F.max(F.struct(*measures)).alias("best")
    return found.groupBy("key", "item").agg(best).select("key", "item", *[f"best.{m}" for m in measures])


def test_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark table as items: of a text's words the last third is taken for the answer."""
    words = F.filter(F.split("text", f"{SPACE}+", -1), lambda w: w != "")
    split = table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("long").alias("item"), words.alias("w"))
    cut = F.ceil(F.size("w") * 2 / 3).cast("int")
    return split.filter(F.size("w") > 0).select(
        "item",
        F.array_join(F.slice("w", F.lit(1), cut), " ").alias("question"),
        F.array_join(F.slice("w", cut + 1, F.size("w")), " ").alias("answer"),
    )


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold test items: one row for each document and item."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("key"), "text")
    found = contaminated(docs, test_items(spark, sf_dir))
    return found.select(
        F.col("key").alias("doc_id"), F.col("item").alias("item_id"), "score", "question_overlap", "answer_overlap"
    )


def stage_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that hold a test item go."""
    key = F.struct("doc_id", F.xxhash64("text").alias("hash")).alias("key")
    packed = docs.select(F.struct("*").alias("row"), key, "text")
    found = contaminated(packed.select("key", "text"), test_items(spark, sf_dir)).select("key").distinct()
    return packed.join(found.hint("shuffle_hash"), "key", "left_anti").select("row.*")
