"""SimHash near-duplicates through a Gray-order hierarchical index.

Fingerprints are 64 bits. The distinct ones are sorted by Gray rank, where neighbours differ in few bits, and cut into
blocks of equal size by range partitioning. Every run of neighbours is a node that holds the bits all its members
share (mask and pattern); nodes of nodes hold fewer. A search carries the differences found so far down the tree: a
child adds only the differences in bits that its parent did not have, and a group whose sum exceeds the limit is left
out as a whole. At single fingerprints the sum is the exact distance.

The top of the index, one node for each block, routes every fingerprint to the blocks that may hold partners. There are
at most MOST_BLOCKS blocks whatever the input, so the routing nodes stay within 64 KB; no fingerprint leaves the
executors. Inside a block the members' own tree is built once and the routed fingerprints stream through it. A block
reports a spanning set of its links, not all pairs: links among the same members are merged there first, which loses
no connection. Components are then found by shuffles.

Equal fingerprints, however many documents share one, are one row of the index.

Cases: null and empty texts have fingerprint zero, linked like any other. A null doc_id is a document of its own and
never a component's name unless all ids are null. Repeated rows get equal results. An empty table gives an empty
result. Columns other than the named ones are never looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.llm.common import by_value, join_counted, stored, table
from fareloom.llm.graph import components

by_value(__name__)

SHINGLE = 3
SEED = 42
DISTANCE = 2
#: Fingerprints in a block at least, and blocks at most.
BLOCK_ROWS = 512
MOST_BLOCKS = 4096
#: Children of a node.
FAN_OUT = 8
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: str | None) -> int:
    """The 64-bit SimHash of a text's shingles."""
    import xxhash

    words = (text or "").encode().lower().split()  # both treat ASCII characters only
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) < SHINGLE:
        hashes = [digest(b" ".join(words), SEED)]
    else:
        hashes = [digest(b"%b %b %b" % t, SEED) for t in zip(words, words[1:], words[2:], strict=False)]
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):  # a long text in pieces
        bits = np.unpackbits(np.array(hashes[at : at + (1 << 16)], ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame) -> DataFrame:
    """docs (key, text) -> key, fp (the fingerprint's bits as a signed long)."""
    kind = docs.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py()) for t in batch.column("text")], np.uint64)
            yield pa.RecordBatch.from_pydict({"key": batch.column("key"), "fp": pa.array(fps.view(np.int64))})

    return docs.select("key", "text").mapInArrow(run, f"key {kind}, fp long")


def gray_rank(fps: np.ndarray) -> np.ndarray:
    """The place of each code word in Gray order."""
    rank = fps.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """A tree over items in Gray order; an item is a pattern under a mask (all bits for a fingerprint)."""

    def __init__(self, patterns: np.ndarray, masks: np.ndarray | None = None):
        masks = np.full(len(patterns), ALL) if masks is None else masks
        self.levels = [(patterns, masks)]
        while len(self.levels[-1][0]) > FAN_OUT:
            patterns, masks = self.levels[-1]
            starts = np.arange(0, len(patterns), FAN_OUT)
            both = np.bitwise_and.reduceat(patterns, starts)
            either = np.bitwise_or.reduceat(patterns, starts)
            shared = np.bitwise_and.reduceat(masks, starts) & ~(both ^ either)
            self.levels.append((both & shared, shared))

    def search(self, queries: np.ndarray, limit: int = DISTANCE) -> tuple[np.ndarray, np.ndarray]:
        """(query, item) numbers whose accumulated differences are within the limit."""
        top = len(self.levels) - 1
        patterns, masks = self.levels[top]
        query = np.repeat(np.arange(len(queries)), len(patterns))
        node = np.tile(np.arange(len(patterns)), len(queries))
        told = np.bitwise_count((queries[query] ^ patterns[node]) & masks[node]).astype(np.uint8)
        keep = told <= limit
        query, node, told = query[keep], node[keep], told[keep]
        for level in range(top - 1, -1, -1):
            patterns, masks = self.levels[level]
            parent_masks = self.levels[level + 1][1]
            child = (node[:, None] * FAN_OUT + np.arange(FAN_OUT)).ravel()
            parent, query, told = np.repeat(node, FAN_OUT), np.repeat(query, FAN_OUT), np.repeat(told, FAN_OUT)
            real = child < len(patterns)
            child, parent, query, told = child[real], parent[real], query[real], told[real]
            fresh = masks[child] & ~parent_masks[parent]
            told = told + np.bitwise_count((queries[query] ^ patterns[child]) & fresh).astype(np.uint8)
            keep = told <= limit
            query, node, told = query[keep], child[keep], told[keep]
        return query, node


def merged(size: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest number of each number's component, over 0..size-1 with links a-b."""
    root = np.arange(size)
    while len(a):
        ra, rb = root[a], root[b]
        live = ra != rb
        a, b, ra, rb = a[live], b[live], ra[live], rb[live]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            jump = root[root]
            if (jump == root).all():
                break
            root = jump
    return root


def _blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the number of the partition, which is a block."""
    from pyspark import TaskContext

    number = TaskContext.get().partitionId()
    for batch in batches:
        yield pa.RecordBatch.from_pydict(
            {"fp": batch.column("fp"), "block": pa.array(np.full(batch.num_rows, number, np.int32))}
        )


def _ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """fp -> fp, rank: the Gray rank, shifted to signed order."""
    for batch in batches:
        fps = batch.column("fp").to_numpy(zero_copy_only=False)
        rank = (gray_rank(fps.view(np.uint64)) ^ np.uint64(1 << 63)).view(np.int64)
        yield pa.RecordBatch.from_pydict({"fp": batch.column("fp"), "rank": pa.array(rank)})


def links(fps: DataFrame, rows: int) -> DataFrame:
    """Distinct fps (fp) -> (a, b): links that connect all that are within DISTANCE. rows: how many there are."""
    blocks = int(min(MOST_BLOCKS, max(1, rows // BLOCK_ROWS)))
    ranked = fps.mapInArrow(_ranked, "fp long, rank long")
    dealt = ranked.repartitionByRange(blocks, "rank").mapInArrow(_blocked, "fp long, block int")
    index = stored(dealt, "gray-blocks")
    nodes = (
        index.groupBy("block").agg(F.bit_and("fp").alias("both"), F.bit_or("fp").alias("either")).orderBy("block").collect()
    )  # one node for each block, MOST_BLOCKS at most
    both = np.array([n["both"] for n in nodes], np.int64).view(np.uint64)
    either = np.array([n["either"] for n in nodes], np.int64).view(np.uint64)
    names = np.array([n["block"] for n in nodes], np.int32)
    shared = ~(both ^ either)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = GrayIndex(both & shared, shared)
        for batch in batches:
            own = batch.column("fp").to_numpy(zero_copy_only=False)
            home = batch.column("block").to_numpy(zero_copy_only=False)
            for at in range(0, len(own), 4096):
                fp, block = own[at : at + 4096], home[at : at + 4096]
                query, node = top.search(fp.view(np.uint64))
                to = names[node]
                ahead = to > block[query]  # each pair of blocks one way; the own block gets its members anyhow
                yield pa.RecordBatch.from_pydict(
                    {
                        "fp": pa.array(np.concatenate([fp, fp[query[ahead]]])),
                        "block": pa.array(np.concatenate([block, to[ahead]])),
                        "guest": pa.array(np.concatenate([np.zeros(len(fp), bool), np.ones(int(ahead.sum()), bool)])),
                    }
                )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict = {"block": None}

        def close() -> Iterator[pa.RecordBatch]:
            members = state.get("index") and state["index"].levels[0][0]
            if members is None or state["block"] is None:
                return
            a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (state["a"], state["b"]))
            root = merged(len(members), a, b)
            moved = np.flatnonzero(root != np.arange(len(members)))
            if len(moved):
                yield pa.RecordBatch.from_pydict(
                    {"a": pa.array(members[moved].view(np.int64)), "b": pa.array(members[root[moved]].view(np.int64))}
                )

        def pair_up(fp: np.ndarray, is_guest: bool) -> Iterator[pa.RecordBatch]:
            index = state["index"]
            for at in range(0, len(fp), 2048):
                query, item = index.search(fp[at : at + 2048])
                if not len(query):
                    continue
                order = np.argsort(query, kind="stable")
                query, item = query[order], item[order]
                same = query[1:] == query[:-1]
                state["a"].append(item[:-1][same])  # what one fingerprint links is linked
                state["b"].append(item[1:][same])
                if sum(map(len, state["a"])) > 1 << 20:
                    size = len(index.levels[0][0])
                    root = merged(size, np.concatenate(state["a"]), np.concatenate(state["b"]))
                    state["a"], state["b"] = [np.arange(size)], [root]
                if is_guest:
                    first = np.concatenate([[True], ~same])
                    yield pa.RecordBatch.from_pydict(
                        {
                            "a": pa.array(fp[at : at + 2048][query[first]].view(np.int64)),
                            "b": pa.array(index.levels[0][0][item[first]].view(np.int64)),
                        }
                    )

        held: list[np.ndarray] = []

        def build() -> Iterator[pa.RecordBatch]:
            if held:
                members = np.concatenate(held)
                held.clear()
                state["index"] = GrayIndex(members[np.argsort(gray_rank(members))])
                yield from pair_up(state["index"].levels[0][0], False)

        for batch in batches:
            fp = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            block = batch.column("block").to_numpy(zero_copy_only=False)
            guest = batch.column("guest").to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((block[1:] != block[:-1]) | (guest[1:] != guest[:-1])) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(fp)], strict=True):
                if lo == hi:
                    continue
                if block[lo] != state["block"]:
                    yield from build()
                    yield from close()
                    state = {"block": block[lo], "a": [], "b": [], "index": None}
                if guest[lo]:
                    yield from build()
                    yield from pair_up(fp[lo:hi], True)
                else:
                    held.append(fp[lo:hi].copy())
        yield from build()
        yield from close()

    routed = index.mapInArrow(route, "fp long, block int, guest boolean")
    sorted_in = routed.repartition(blocks, "block").sortWithinPartitions("block", "guest")
    return sorted_in.mapInArrow(search, "a long, b long")


def clustered(docs: DataFrame, name: str = "doc_id") -> DataFrame:
    """docs (key, name, text) -> (key, name, fp, component): the smallest `name` that can be reached."""
    prints = stored(fingerprints(docs), "fingerprints")
    named = prints.select("key.*", "fp")
    distinct = stored(
        named.groupBy("fp").agg(F.min(name).alias("least"), F.count(F.lit(1)).alias("copies")), "distinct-fingerprints"
    )
    found = stored(links(distinct.select("fp"), distinct.count()), "fingerprint-links")
    roots = components(found)
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    best = rooted.groupBy("root").agg(F.min("least").alias("component"))
    sized = rooted.groupBy("root").agg(F.count(F.lit(1)).alias("fps"))
    rooted = stored(rooted, "rooted")
    named_roots = stored(
        join_counted(rooted, best.join(sized, "root"), "root", "fps").select("fp", "component", "copies"), "components"
    )
    return join_counted(named, named_roots, "fp", "copies")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    docs = table(spark, sf_dir, "documents").select(F.struct("doc_id").alias("key"), "text")
    return clustered(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id")
    )


def stage_simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each component the document with the smallest id stays."""
    tied = F.xxhash64("row.source", "row.lang", "row.text")
    # Null ids are larger than others; equal ids are told apart by content.
    name = F.struct(F.col("row.doc_id").isNull().alias("no_id"), F.col("row.doc_id").alias("doc_id"), tied.alias("hash"))
    packed = docs.select(F.struct("*").alias("row")).select("row", name.alias("name"), F.col("row.text").alias("text"))
    found = clustered(packed.select(F.struct("name").alias("key"), "text"), "name")
    stays = found.groupBy("component").agg(F.count(F.lit(1)).alias("documents")).select(F.col("component").alias("name"))
    once = packed.select("row", "name").join(stays.hint("shuffle_hash"), "name", "left_semi")
    return once.dropDuplicates(["name"]).select("row.*")
