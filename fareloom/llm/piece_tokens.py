"""SentencePiece encoding and decoding by a table of distinct chunks.

The model's normaliser only marks spaces, and none of its pieces holds a marker after another character. So no merge
crosses the place where a marker follows another character, and a text is the sequence of its marked words: runs of
markers with the characters up to the next marker. In every batch of rows each distinct marked word is segmented once,
by the library, and the ids are joined back by position. What a task has learned is kept for its next batches, up to
TABLE_ROWS words; words longer than LONG_WORD are segmented where they stand. Nothing is shuffled.

`ChunkTable` refuses a model that does not have these properties.

Cases: a null or empty text is the end id alone and decodes to the empty text. Repeated rows get equal results. A
word of any length is segmented whole. An empty table gives an empty result. Columns other than the named ones are
never looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.llm.common import by_value, table

by_value(__name__)

MARK = "▁"
#: Words kept in a task's table, and characters in a word that is kept.
TABLE_ROWS = 300_000
LONG_WORD = 64
MODEL = "piece_bpe_32k.model"


def model_path(name: str = MODEL) -> str:
    """Where the public vocabulary lies on the machine that asks."""
    import public_tokenizers

    return public_tokenizers.path(name)


class ChunkTable:
    """Distinct marked words of one model: ids as decimal text, and the decoded text."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = (self.model.id_to_piece(i) for i in range(self.model.get_piece_size()))
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces):
            raise ValueError("a piece crosses a white-space marker: words cannot be segmented alone")
        if self.model.decode(self.model.encode(" a  b ")) != " a  b ":
            raise ValueError("the model changes white space: words cannot be segmented alone")
        self.lone = self.model.piece_to_id(MARK)
        self.end = str(self.model.eos_id())
        self.rows: dict[str, tuple[str, str]] = {}

    def segment(self, chunk: str) -> tuple[str, str]:
        """A marked word's ids and decoded text, both as they stand inside a text."""
        if chunk == MARK:
            ids = [self.lone]
        else:  # the library puts the first marker itself
            ids = self.model.encode(chunk[1:])
        # Decoding drops one marker at the start, as it does once for a whole text.
        return " ".join(map(str, ids)), " " + self.model.decode(ids)

    def look_up(self, chunks: list[str]) -> tuple[list[str], list[str]]:
        """The rows of a text's chunks, by position; unknown ones are segmented, each once."""
        rows = self.rows
        own: dict[str, tuple[str, str]] = {}
        for chunk in {c for c in chunks if c not in rows}:
            (own if len(chunk) > LONG_WORD else rows)[chunk] = self.segment(chunk)
        found = [rows[c] for c in chunks] if not own else [own.get(c) or rows[c] for c in chunks]
        if len(rows) > TABLE_ROWS:
            self.rows = {}
        return [x[0] for x in found], [x[1] for x in found]

    def encode(self, text: str | None) -> tuple[str, str]:
        """All ids as decimal text, the end id last, and the decoded text."""
        if not text:
            return self.end, ""
        if MARK in text or "  " in text or text[0] == " " or text[-1] == " ":
            chunks = re.findall(f"{MARK}+[^{MARK}]*", MARK + text.replace(" ", MARK))
        else:
            chunks = [MARK + w for w in text.split(" ")]
        ids, decoded = self.look_up(chunks)
        return " ".join(ids) + " " + self.end, "".join(decoded)[1:]


def encode_texts(docs: DataFrame, path: str | None = None, full: bool = False) -> DataFrame:
    """docs (doc_id, text) -> doc_id, n_tokens, ids_sha256, decoded_sha256; with `full` also ids and decoded.

    path: the model file; if None, each task asks for the public vocabulary's place.
    """
    kind = docs.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = ChunkTable(path or model_path())
        for batch in batches:
            counts, id_hashes, text_hashes, ids, texts = [], [], [], [], []
            for text in batch.column("text"):
                coded, decoded = chunks.encode(text.as_py())
                counts.append(coded.count(" ") + 1)
                id_hashes.append(hashlib.sha256(coded.encode()).hexdigest())
                text_hashes.append(hashlib.sha256(decoded.encode()).hexdigest())
                if full:
                    ids.append([int(x) for x in coded.split(" ")])
                    texts.append(decoded)
            columns = {
                "doc_id": batch.column("doc_id"),
                "n_tokens": pa.array(counts, pa.int64()),
                "ids_sha256": pa.array(id_hashes, pa.string()),
                "decoded_sha256": pa.array(text_hashes, pa.string()),
            }
            if full:
                columns |= {"ids": pa.array(ids, pa.list_(pa.int32())), "decoded": pa.array(texts, pa.string())}
            yield pa.RecordBatch.from_pydict(columns)

    schema = f"doc_id {kind.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", "text").mapInArrow(run, schema + (", ids array<int>, decoded string" if full else ""))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded."""
    return encode_texts(table(spark, sf_dir, "documents"))


def stage_sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage, the last: the ids of every document that is left."""
    return encode_texts(docs, full=True).drop("decoded").withColumn("ids", F.col("ids"))
