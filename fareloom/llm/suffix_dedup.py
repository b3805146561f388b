"""Removal of repeated strings by merged Burrows-Wheeler transforms.

A byte goes if a LENGTH-byte string that covers it also starts anywhere else. Two steps find them all.

Candidates. Every LENGTH-byte window picks the GRAM-byte string of smallest hash inside it, its anchor. Equal windows
pick equal anchors at equal places, so a repeated string shows as an anchor that stands at several places. The context
of an anchor holds the windows that pick it, which lie side by side, and no others: equal windows pick alike. Where two
places have equal contexts, all of a context is repeated; only anchors with several different contexts are left to
compare.

Comparison. The contexts of an anchor meet in one partition. Windows with a symbol that stands nowhere else at its
place cannot repeat and are left out. The rest is cut into shards; the suffixes of each shard are
sorted once, which gives its transform: in suffix order, what stands before each suffix. The transforms are merged by
refining the interleave of the shards: a pass over the current interleave hands out each shard's symbols in order and
sorts them stably, after which the interleave is that of one symbol more. No suffix is compared again. Places where
neighbours part give the common prefixes; once they are LENGTH bytes long, an interval of several suffixes is a
repeated string. A symbol here is a hash of STRIDE bytes, their anchor and their place relative to it, as equal windows
have equal places; so LENGTH / STRIDE passes do. A text's symbols end where the last STRIDE bytes begin.

Texts meet the requests for contexts, and later the spans, in two joins. A bitmap of fixed size keeps texts that have
no request out of those shuffles; when it fills up, they only get larger.

Cases: null and empty texts have no bytes. Texts shorter than LENGTH keep everything. Repeated rows are repeated
strings. Long texts are worked on in pieces that overlap. An empty table gives an empty result. Columns other than the
named ones are never looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.llm.common import by_value, join_counted, stored, table

by_value(__name__)

LENGTH = 200
GRAM = 32
STRIDE = 50
#: Bytes of texts in one vectorised step; longer texts are cut into pieces of this.
PIECE = 2_000_000
#: Bytes of contexts that are merged at once (an anchor's stay together), and in one shard.
CHUNK, SHARD = 1_200_000, 300_000
#: Words of 64 bits in the bitmap.
BITMAP = 1 << 17
_BASE = 0x9E3779B97F4A7C15
_VALUES = np.random.default_rng(20240101).integers(1, 2**64, 256, dtype=np.uint64)


class RollingHash:
    """Hashes of any substring of a buffer, by differences of prefix sums modulo 2**64."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        power = np.full(n + 1, _BASE, np.uint64)
        power[0] = 1
        power = np.cumprod(power)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_VALUES[data] * power[:n], out=self.sums[1:])
        inverse = np.full(n + 1, pow(_BASE, -1, 2**64), np.uint64)
        inverse[0] = 1
        self.inverse = np.cumprod(inverse)

    def of(self, start: np.ndarray | slice, end: np.ndarray | slice) -> np.ndarray:
        """Mixed hashes of data[start:end]."""
        h = (self.sums[end] - self.sums[start]) * self.inverse[start]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(32))


def sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """pick over every `width` neighbours."""
    out, reach = values, 1
    while reach * 2 <= width:
        out = pick(out[:-reach], out[reach:])
        reach *= 2
    rest = width - reach
    return pick(out[: len(out) - rest], out[rest:]) if rest else out


def anchors_of(pieces: list[tuple[int, int, int, int, bytes, int]]) -> tuple[np.ndarray, ...]:
    """(text, position, anchor, context, lead, size) of all anchors.

    A context starts `lead` bytes before its anchor.

    pieces: (text, offset, first, last, data, total): data starts at `offset` of a text of `total` bytes, and windows
    that start in first..last-1 count.
    """
    sizes = np.array([len(p[4]) for p in pieces], np.int64)
    data = np.frombuffer(b"".join(p[4] for p in pieces), np.uint8)
    n = len(data)
    none = tuple(np.zeros(0, np.int64) for _ in range(6))
    if n < LENGTH:
        return none
    start = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(pieces)), sizes)
    text, offset, first, last, total = (np.array([p[i] for p in pieces], np.int64) for i in (0, 1, 2, 3, 5))
    rolling = RollingHash(data)
    grams = rolling.of(slice(0, n - GRAM + 1), slice(GRAM, n + 1))
    width = LENGTH - GRAM + 1
    least = sliding(grams, width, np.minimum)
    at = np.arange(len(least))
    own = owner[: len(least)]
    here = at - start[own] + offset[own]
    least[at + LENGTH > start[own] + sizes[own]] = 0
    counted = np.where((here >= first[own]) & (here < last[own]), least, np.uint64(0))
    padded = np.concatenate([np.zeros(width - 1, np.uint64), counted, np.zeros(width - 1, np.uint64)])
    chosen = np.flatnonzero((sliding(padded, width, np.maximum) == grams) & (grams > 0))
    lo, hi = picking(least, chosen, grams[chosen], width)
    hi += LENGTH
    own = owner[chosen]
    shift = start[own] - offset[own]
    lead = chosen - lo
    context = rolling.of(lo, hi) + lead.astype(np.uint64) * np.uint64(_BASE)
    return text[own], chosen - shift, grams[chosen].view(np.int64), context.view(np.int64), lead, hi - lo


def picking(least: np.ndarray, chosen: np.ndarray, values: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last of the windows that pick each chosen gram, by the least value of every window.

    They lie side by side, so they are what one run of equal values has within reach of the gram.
    """
    edge = np.flatnonzero(least[1:] != least[:-1]) + 1
    begin, end = np.concatenate([[0], edge]), np.concatenate([edge, [len(least)]])
    kinds, kind = np.unique(least[begin], return_inverse=True)
    reach = len(least) + 1
    order = np.argsort(kind.ravel() * reach + end)
    keys = kind.ravel()[order] * reach + end[order]
    far = np.maximum(0, chosen - width + 1)
    run = order[np.searchsorted(keys, np.searchsorted(kinds, values) * reach + far, "right")]
    return np.maximum(begin[run], far), np.minimum(end[run] - 1, chosen)


def anchors(docs: DataFrame) -> DataFrame:
    """docs (key, text) -> key, at, anchor, context, lead, size."""

    def told(keys: np.ndarray, pieces: list, known: np.ndarray | None = None) -> tuple[pa.RecordBatch, np.ndarray]:
        text, place, anchor, context, lead, size = anchors_of(pieces)
        new = slice(None) if known is None else ~np.isin(place, known)
        columns = {
            "key": pa.array(keys[text[new]]),
            "at": pa.array(place[new]),
            "anchor": pa.array(anchor[new]),
            "context": pa.array(context[new]),
            "lead": pa.array(lead[new].astype(np.int32)),
            "size": pa.array(size[new].astype(np.int32)),
        }
        return pa.RecordBatch.from_pydict(columns), place

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_numpy(zero_copy_only=False)
            pieces, held = [], 0
            for i, value in enumerate(batch.column("text")):
                data = (value.as_py() or "").encode()
                if len(data) < LENGTH:
                    continue
                if len(data) > PIECE:
                    yield from long_text(keys, i, data)
                    continue
                pieces.append((i, 0, 0, len(data), data, len(data)))
                held += len(data)
                if held > PIECE:
                    yield told(keys, pieces)[0]
                    pieces, held = [], 0
            if pieces:
                yield told(keys, pieces)[0]

    def long_text(keys: np.ndarray, i: int, data: bytes) -> Iterator[pa.RecordBatch]:
        """Piece after piece; an anchor that two pieces find is told once, with all windows that pick it."""
        known = np.zeros(0, np.int64)
        for first in range(0, len(data), PIECE):
            lo, hi = max(0, first - 2 * LENGTH), min(len(data), first + PIECE + 2 * LENGTH)
            found, place = told(keys, [(i, lo, first, first + PIECE, data[lo:hi], len(data))], known)
            known = place[-4 * LENGTH :]
            yield found

    return docs.select("key", "text").mapInArrow(run, "key long, at long, anchor long, context long, lead int, size int")


def in_order(values: np.ndarray, limit: int) -> np.ndarray:
    """Stable order of whole numbers below `limit`: sorted together with their places where both fit a word."""
    bits = len(values).bit_length()
    if limit.bit_length() + bits > 63:
        return np.argsort(values, kind="stable")
    return np.sort((values.astype(np.int64) << bits) | np.arange(len(values))) & ((1 << bits) - 1)


def numbered(hashes: np.ndarray) -> np.ndarray:
    """Numbers from 0 that are equal where the hashes are.

    Hashes are sorted by their upper bits, with their places; should different ones agree in those, by all bits.
    """
    bits = max(len(hashes).bit_length(), 1)
    places = np.arange(len(hashes), dtype=np.uint64)
    order = (np.sort((hashes >> np.uint64(bits) << np.uint64(bits)) | places) & np.uint64((1 << bits) - 1)).astype(np.int64)
    ranked = hashes[order]
    parts = ranked[1:] != ranked[:-1]
    if (parts & (ranked[1:] >> np.uint64(bits) == ranked[:-1] >> np.uint64(bits))).any():
        order = np.argsort(hashes, kind="stable")
        parts = hashes[order[1:]] != hashes[order[:-1]]
    out = np.empty(len(hashes), np.int64)
    out[order] = np.concatenate([[0], np.cumsum(parts)])[: len(hashes)]
    return out


def transform_of(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order to LENGTH bytes of a shard, and its transform: the symbol before each suffix in that order.

    symbols[i] is a number for the STRIDE bytes from i on. Ranks of STRIDE bytes give those of twice as many, and so on.
    """
    n = len(symbols)
    rank, reach = symbols, STRIDE
    while reach < LENGTH:
        limit = int(rank.max()) + 1
        key = rank * limit + np.roll(rank, -reach)
        order = in_order(key, limit * limit)
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(key[order[1:]] != key[order[:-1]])])
        reach *= 2
    return order, symbols[(order - STRIDE) % n]


def merged_intervals(transforms: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(shard of each suffix in merged order, interval of each suffix).

    An interval is a maximal run of suffixes whose common prefix is LENGTH bytes or more.
    """
    source = np.repeat(np.arange(len(transforms), dtype=np.int32), [len(t) for t in transforms])
    interval = np.zeros(len(source), np.int64)
    limit = max(int(t.max()) for t in transforms) + 1
    for _ in range(LENGTH // STRIDE):
        symbol = np.empty(len(source), np.int64)
        for shard, transform in enumerate(transforms):
            symbol[source == shard] = transform  # a shard's suffixes keep their order in any interleave
        order = in_order(symbol, limit)
        source, symbol, interval = source[order], symbol[order], interval[order]
        parts = (symbol[1:] != symbol[:-1]) | (interval[1:] != interval[:-1])  # the common prefix ends here
        interval = np.concatenate([[0], np.cumsum(parts)])
    return source, interval


def repeated_windows(data: np.ndarray, sizes: np.ndarray, origins: np.ndarray) -> np.ndarray:
    """Whether the window that starts at each byte also starts in another text at the same place.

    data: the joined texts of at least LENGTH bytes; origins: a number for the place of each text's first byte; the
    next bytes have the next numbers.
    """
    total = int(sizes.sum())
    ends = np.cumsum(sizes)
    left = np.repeat(ends, sizes) - np.arange(total)
    out = np.zeros(total, bool)
    at = np.flatnonzero(left >= STRIDE)  # where symbols start
    places = (np.repeat(origins - ends + sizes, sizes) + np.arange(total))[at]
    symbols = numbered(RollingHash(data).of(slice(0, total - STRIDE + 1), slice(STRIDE, total + 1))[at] + places.astype(np.uint64) * np.uint64(_BASE))
    # Windows all of whose symbols stand elsewhere too, and the symbols of such windows.
    several = np.zeros(total, bool)
    several[at] = np.bincount(symbols)[symbols] > 1
    window = left >= LENGTH
    for step in range(0, LENGTH, STRIDE):
        window[: total - step] &= several[step:]
    if not window.any():
        return out
    windows = np.concatenate([np.zeros(LENGTH - STRIDE + 1, np.int64), np.cumsum(window)])
    kept = (windows[LENGTH - STRIDE + 1 :] > windows[: -(LENGTH - STRIDE + 1)])[at]
    at, symbols = at[kept], symbols[kept]
    # A shard ends with a text, or where symbols are left out.
    gaps = np.concatenate([np.flatnonzero(np.diff(at) > 1) + 1, [len(at)]])
    ends = gaps[np.concatenate([np.diff(gaps // SHARD) > 0, [True]])]
    orders, transforms = [], []
    for begin, end in zip(np.concatenate([[0], ends[:-1]]), ends, strict=True):
        order, transform = transform_of(symbols[begin:end])
        orders.append(order + begin)
        transforms.append(transform)
    source, interval = merged_intervals(transforms)
    place = np.empty(len(source), np.int64)
    for shard, order in enumerate(orders):
        place[source == shard] = order
    # Only intervals of several windows matter; the symbols behind a text's last window are no windows.
    place = at[place]
    windows = window[place]
    place, interval = place[windows], interval[windows]
    out[place[np.bincount(interval)[interval] > 1]] = True
    return out


def covered_runs(twice: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, end) of the runs of bytes that the marked windows cover, within each of the joined texts."""
    begins = np.cumsum(sizes) - sizes
    starts = np.flatnonzero(twice)
    if not len(starts):
        return starts, starts, starts
    text = np.repeat(np.arange(len(sizes)), sizes)[starts]
    apart = np.flatnonzero((np.diff(starts) > LENGTH) | (np.diff(text) > 0))
    first, last = np.concatenate([[0], apart + 1]), np.concatenate([apart, [len(starts) - 1]])
    text = text[first]
    return text, starts[first] - begins[text], starts[last] - begins[text] + LENGTH


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(anchor, context, lead, data), sorted by anchor -> (anchor, context, spans) of contexts that repeat in part."""

    def flush(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        anchor, context, lead = (np.concatenate([b.column(c).to_numpy() for b in held]) for c in ("anchor", "context", "lead"))
        texts = [t for b in held for t in b.column("data").to_pylist()]
        # Repeated rows bring a context several times.
        order = np.lexsort((context, anchor))
        once = np.ones(len(order), bool)
        once[1:] = (np.diff(anchor[order]) != 0) | (np.diff(context[order]) != 0)
        order = order[once]
        anchor, context, lead, texts = anchor[order], context[order], lead[order], [texts[k] for k in order.tolist()]
        sizes = np.array([len(t) for t in texts], np.int64)
        group = np.concatenate([[0], np.cumsum(np.diff(anchor) != 0)])
        # The place of a byte is told by its anchor and its distance from it.
        twice = repeated_windows(np.frombuffer(b"".join(texts), np.uint8), sizes, (group * 4 + 1) * LENGTH - lead)
        text, start, end = covered_runs(twice, sizes)
        found, counts = np.unique(text, return_counts=True)
        spans = pa.StructArray.from_arrays([pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32))], ["start", "end"])
        offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [pa.array(anchor[found]), pa.array(context[found]), pa.ListArray.from_arrays(pa.array(offsets), spans)],
            ["anchor", "context", "spans"],
        )

    held: list[pa.RecordBatch] = []
    size, last = 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        anchor = batch.column("anchor").to_numpy()
        upto = np.concatenate([[0], np.cumsum(pc.binary_length(batch.column("data")).to_numpy())])
        starts = np.flatnonzero(np.concatenate([[last is None or anchor[0] != last], np.diff(anchor) != 0]))
        at = 0
        for k in starts.tolist():
            if size + upto[k] - upto[at] > CHUNK:
                yield flush([*held, batch.slice(at, k - at)])
                held, size, at = [], 0, k
        held.append(batch.slice(at))
        size, last = size + upto[-1] - upto[at], anchor[-1]
    if held:
        yield flush(held)


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, wanted) -> the contexts asked for."""
    for batch in batches:
        wanted = batch.column("wanted")
        asked = wanted.flatten()
        lead = asked.field("lead")
        lo = pc.subtract(asked.field("at"), lead)
        hi = pc.add(lo, asked.field("size")).to_pylist()
        lo, rows, k = lo.to_pylist(), [], 0
        for text, n in zip(batch.column("text").to_pylist(), pc.list_value_length(wanted).to_pylist(), strict=True):
            data = text.encode()
            rows.extend([data[lo[j] : hi[j]] for j in range(k, k + n)])
            k += n
        yield pa.RecordBatch.from_arrays(
            [asked.field("anchor"), asked.field("context"), lead, pa.array(rows, pa.binary())], ["anchor", "context", "lead", "data"]
        )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id columns, text, spans) -> what is left of each text."""
    for batch in batches:
        out: dict[str, list] = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept": []}
        spans = batch.column("spans")
        listed = spans.flatten()
        starts, ends = listed.field("start").to_numpy(), listed.field("end").to_numpy()
        k = 0
        for text, n in zip(batch.column("text").to_pylist(), pc.list_value_length(spans).to_pylist(), strict=True):
            data = (text or "").encode()
            kept, at, runs, removed = [], 0, 0, 0
            for lo, hi in joined_runs(starts[k : k + (n or 0)], ends[k : k + (n or 0)]):
                kept.append(data[at:lo])
                runs += 1
                removed += hi - lo
                at = hi
            k += n or 0
            kept.append(data[at:])
            for name, value in zip(out, (len(data), removed, runs, b"".join(kept)), strict=True):
                out[name].append(value)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("id"),
                *(pa.array(out[c], pa.int64()) for c in ("n_bytes", "n_removed", "n_spans")),
                pa.array([hashlib.sha256(k).hexdigest() for k in out["kept"]]),
            ],
            ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def joined_runs(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Ranges in any order, which may overlap or touch, as the runs that they cover."""
    if not len(starts):
        return []
    order = np.argsort(starts)
    starts, upto = starts[order], np.maximum.accumulate(ends[order])
    apart = np.flatnonzero(starts[1:] > upto[:-1])
    return list(zip(starts[np.concatenate([[0], apart + 1])].tolist(), upto[np.concatenate([apart, [len(upto) - 1]])].tolist(), strict=True))


def bitmap_of(keys: DataFrame) -> DataFrame:
    """(word, bits): at most BITMAP rows that mark the keys' places."""
    return keys.select(*_place("key")).groupBy("word").agg(F.bit_or("bit").alias("bits"))


def _place(key: str) -> list:
    hashed = F.xxhash64(F.col(key), F.lit("bitmap"))
    return [
        F.pmod(hashed, F.lit(BITMAP)).cast("int").alias("word"),
        F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.shiftright(hashed, 32), F.lit(64)).cast("int")).alias("bit"),
    ]


def split_by_bitmap(docs: DataFrame, bitmap: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that may be marked, rows that are not)."""
    placed = docs.select("*", *_place("key")).join(F.broadcast(bitmap), "word", "left")  # BITMAP rows at most
    marked = F.coalesce(F.col("bits").bitwiseAND(F.col("bit")) != 0, F.lit(False))
    columns = docs.columns
    return placed.filter(marked).select(*columns), placed.filter(~marked).select(*columns)


def spans_of(docs: DataFrame) -> DataFrame:
    """docs (key, text) -> key, spans: byte ranges to remove, which may overlap; only texts that have any."""
    found = stored(anchors(docs), "anchors")
    counts = stored(found.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "repeated-anchors")
    live = stored(join_counted(found, counts, "anchor", "n", "inner"), "live-anchors")
    contexts = stored(
        live.groupBy("anchor", "context").agg(
            F.count(F.lit(1)).alias("copies"), F.min(F.struct("key", "at", "lead", "size")).alias("first")
        ),
        "contexts",
    )
    several = stored(contexts.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "contested-anchors")
    contested = join_counted(contexts, several, "anchor", "n", "inner")
    wanted = stored(
        contested.select("first.*", "anchor", "context")
        .groupBy("key")
        .agg(F.collect_list(F.struct("at", "lead", "size", "anchor", "context")).alias("wanted")),
        "requests",
    )
    asked, _ = split_by_bitmap(docs, bitmap_of(wanted))
    fetched = asked.join(wanted, "key").select("text", "wanted").mapInArrow(_fetch, "anchor long, context long, lead int, data binary")
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), several.agg(F.sum("n")).first()[0] or 0, 1)
    parts = min(parts, max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), parts // 8192))
    compared = (
        fetched.repartition(parts, "anchor")
        .sortWithinPartitions("anchor")
        .mapInArrow(_compare, "anchor long, context long, spans array<struct<start:int,end:int>>")
    )
    name = F.struct("anchor", "context").alias("name")
    whole = contexts.filter("copies > 1").select(name, F.array(F.struct(F.lit(0).alias("start"), F.col("first.size").alias("end"))).alias("spans"))
    verdicts = whole.unionByName(compared.select(name, "spans")).groupBy("name").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    counted = stored(verdicts.join(contexts.select(name, "copies"), "name"), "verdicts")
    hit = join_counted(live.select("key", (F.col("at") - F.col("lead")).alias("lo"), name), counted, "name", "copies", "inner")
    # Repeated rows have one key and give equal lists, which a set holds once.
    return hit.groupBy("key").agg(
        F.flatten(
            F.collect_set(
                F.transform("spans", lambda s: F.struct((F.col("lo") + s["start"]).alias("start"), (F.col("lo") + s["end"]).alias("end")))
            )
        ).alias("spans")
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """docs (id, text) -> id, n_bytes, n_removed, n_spans, kept_sha256."""
    keyed = docs.select("id", F.coalesce("text", F.lit("")).alias("text"))
    keyed = keyed.withColumn("key", F.xxhash64("id", "text"))
    spans = stored(spans_of(keyed.select("key", "text")), "spans")
    some, none = split_by_bitmap(keyed, bitmap_of(spans.select("key")))
    kind = docs.schema["id"].dataType.simpleString()
    cut = some.join(spans, "key", "left").select("id", "text", "spans").mapInArrow(
        _cut, f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )
    data = F.encode("text", "UTF-8")
    nothing = F.lit(0).cast("long")
    whole = none.select("id", F.octet_length(data).cast("long").alias("n_bytes"), nothing.alias("n_removed"), nothing.alias("n_spans"), F.sha2(data, 256).alias("kept_sha256"))
    return whole.unionByName(cut)


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its repeated strings."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    return deduplicated(docs).withColumnRenamed("id", "doc_id")
