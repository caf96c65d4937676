"""Token ids as bit-packed blocks: written in id order, read back by block or document.

A token file is a folder with two Parquet tables. ``blocks`` has a row per block:
shard, number within the shard, first token within the shard, and the block's ids in
the fewest bits that hold the vocabulary, plus the documents in it and where each
begins. ``shards`` has a row per shard with the tokens of all shards before it, the
bits of an id and the end id. A block holds whole documents, so each can be unpacked
by itself: any document's bits follow from its offset, without reading the others.

Defined results: a null or empty text is the end id alone; repeated ids are separate
documents, in the order of their texts' hashes; null ids come first; an id that is no
whole number is stored as null; an empty table gives a file without blocks; other columns
are not read, whatever their names. Texts are encoded whole; a worker holds a block, which
closes after the document that fills it, so memory grows with the longest text.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from spintally.llm import ragged
from spintally.llm.pretokens import PieceTable, encode_slice
from spintally.llm.rows import SLICE_BYTES, bounded, ship, slices, strings

#: A block closes once it holds this many ids.
BLOCK_IDS = 1 << 18
MEMO_PIECES = 600_000
JOINED_WORDS = 1000
#: How byte-level vocabularies write a space.
SPACE = "\u0120"
#: A space and letters of early code points, of which all Unicode versions know the class.
SPACED_WORD = re.compile(r" [A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+")

BLOCK_FIELDS = (
    "shard int, block int, first_token long, n_ids long, payload binary, "
    "doc_ids array<long>, doc_starts array<long>"
)


def bits_for(vocabulary_size: int) -> int:
    return max(1, (vocabulary_size - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids as consecutive ``bits``-wide little-endian fields, padded to a whole byte."""
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"an id needs more than {bits} bits")
    if bits == 16:
        return ids.astype("<u2").tobytes()
    out = []
    for begin in range(0, len(ids), 1 << 16):  # a multiple of 8 ids fills whole bytes
        raw = ids[begin : begin + (1 << 16)].astype("<u4").view(np.uint8).reshape(-1, 4)
        spread = np.unpackbits(raw, axis=1, bitorder="little")[:, :bits]
        out.append(np.packbits(spread.reshape(-1), bitorder="little").tobytes())
    return b"".join(out)


def unpack(payload: bytes, bits: int, first: int, count: int) -> np.ndarray:
    """``count`` ids from the ``first`` on, touching only the bytes that hold them."""
    if bits in (8, 16, 32):
        return np.frombuffer(payload, f"<u{bits // 8}", count, first * bits // 8).astype(np.uint32)
    at = np.arange(first, first + count, dtype=np.int64) * bits
    low = first * bits // 8
    data = np.frombuffer(payload, np.uint8)[low : (first + count) * bits // 8 + 1]
    data = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    place = (at >> 3) - low
    word = data[place]
    for byte in range(1, (bits + 7) // 8 + 1):
        word |= data[place + byte] << np.uint64(8 * byte)
    word >>= (at & 7).astype(np.uint64)
    return (word & np.uint64((1 << bits) - 1)).astype(np.uint32)


class PieceEncoder:
    """A tokenizers file; each distinct pre-token goes through the library once."""

    def __init__(self, file: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        self.tokenizer = Tokenizer.from_buffer(file)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.size = self.tokenizer.get_vocab_size()
        self.table = PieceTable(MEMO_PIECES, self.encode_pieces)
        vocabulary = self.tokenizer.get_vocab()
        self.begins_word = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.begins_word[[i for token, i in vocabulary.items() if token[0] == SPACE]] = True

    def encode_each(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        made = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        ids = [encoding.ids for encoding in made]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes.sum())), sizes

    def encode_spaced(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words that begin with a space, many in one text for the library.

        Such a text falls apart into just these words, and the token that begins a word
        is the one that begins with a space.
        """
        texts = ["".join(words[i : i + JOINED_WORDS]) for i in range(0, len(words), JOINED_WORDS)]
        ids, _ = self.encode_each(texts)
        starts = np.flatnonzero(self.begins_word[ids])
        if len(starts) != len(words):
            return self.encode_each(words)
        return ids, np.diff(np.append(starts, len(ids)))

    def encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct pre-tokens and the number of each."""
        spaced = np.fromiter(map(bool, map(SPACED_WORD.fullmatch, pieces)), bool, len(pieces))
        sizes = np.zeros(len(pieces), np.int64)
        parts = []
        for own, encode in ((spaced, self.encode_spaced), (~spaced, self.encode_each)):
            at = np.flatnonzero(own)
            ids, sizes[at] = encode([pieces[i] for i in at.tolist()])
            parts.append(ids)
        out = np.empty(int(sizes.sum()), np.uint32)
        inside = np.repeat(spaced, sizes)
        out[inside], out[~inside] = parts
        return out, sizes

    def encode(self, texts: list[str], pattern: str) -> tuple[np.ndarray, np.ndarray]:
        """A text with the string of an added token goes through the library whole."""
        whole = {row for row, text in enumerate(texts) if any(a in text for a in self.added)}
        if not whole:
            return encode_slice(texts, pattern, self.table)
        parts = []
        for row, text in enumerate(texts):
            if row in whole:
                ids = self.tokenizer.encode(text, add_special_tokens=False).ids
                parts.append(np.array(ids, np.uint32))
            else:
                parts.append(encode_slice([text], pattern, self.table)[0])
        return np.concatenate(parts), np.array([len(p) for p in parts])


@lru_cache(maxsize=2)
def encoder(file: bytes) -> PieceEncoder:
    return PieceEncoder(file)


def blocks(
    docs: DataFrame,
    tokenizer_path: str,
    pattern: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_ids: int = BLOCK_IDS,
) -> DataFrame:
    """The rows of ``blocks``; shards follow each other in the order of ``id_col``."""
    spark = docs.sparkSession
    bounded(spark)
    ship(spark)
    with open(tokenizer_path, "rb") as file:
        held = spark.sparkContext.broadcast(file.read())
    rows = docs.select(
        F.col(f"`{id_col}`").try_cast("long").alias("doc_id"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
    ).withColumn("tie", F.xxhash64("text"))
    # a repeated id may hold many rows, so the hash takes part in the cut into ranges
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(shards, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")

    def run(batches):
        own = encoder(held.value)
        bits, shard, block, first = bits_for(own.size), TaskContext.get().partitionId(), 0, 0
        ids, counts, doc_ids, size = [], [], [], 0

        def closed():
            starts = ragged.offsets_of(np.concatenate(counts))
            values = {
                "shard": shard,
                "block": block,
                "first_token": first,
                "n_ids": size,
                "payload": pack(np.concatenate(ids), bits),
                "doc_ids": doc_ids,
                "doc_starts": starts[:-1].tolist(),
            }
            return pa.RecordBatch.from_pylist([values], schema=schema)

        schema = pa.schema(
            [("shard", pa.int32()), ("block", pa.int32()), ("first_token", pa.int64())]
            + [("n_ids", pa.int64()), ("payload", pa.binary())]
            + [("doc_ids", pa.list_(pa.int64())), ("doc_starts", pa.list_(pa.int64()))]
        )
        for batch in batches:
            for part in slices(batch, 1, min(4 * SLICE_BYTES, 4 * block_ids)):
                flat, sizes = own.encode(strings(part.column(1)), pattern)
                flat = np.insert(flat, np.cumsum(sizes), np.uint32(end_id))
                ids.append(flat)
                counts.append(sizes + 1)
                doc_ids += part.column(0).to_pylist()
                size += len(flat)
                if size >= block_ids:
                    yield closed()
                    first, block = first + size, block + 1
                    ids, counts, doc_ids, size = [], [], [], 0
        if doc_ids:
            yield closed()

    return ranged.select("doc_id", "text").mapInArrow(run, BLOCK_FIELDS)


def write(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    pattern: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_ids: int = BLOCK_IDS,
) -> None:
    """Write a token file to ``path``, a new folder that all executors reach."""
    spark = docs.sparkSession
    made = blocks(docs, tokenizer_path, pattern, end_id, id_col, text_col, block_ids)
    made.write.option("compression", "none").parquet(f"{path}/blocks")
    sizes = spark.read.parquet(f"{path}/blocks").groupBy("shard").agg(F.sum("n_ids").alias("n_ids"))
    bits = bits_for(Tokenizer.from_file(tokenizer_path).get_vocab_size())
    before, rows = 0, []
    for shard, n_ids in sorted(sizes.collect()):  # a row per write task
        rows.append((shard, before, n_ids, bits, end_id))
        before += n_ids
    spark.createDataFrame(
        rows, "shard int, tokens_before long, n_ids long, bits int, end_id long"
    ).coalesce(1).write.parquet(f"{path}/shards")


def read(spark: SparkSession, path: str) -> DataFrame:
    """Every document of a token file: ``doc_id``, ``start``, ``n_tokens``, ``ids``.

    ``ids`` are little-endian unsigned 32-bit integers, ``start`` the number of ids of
    all documents before it, ``n_tokens`` counts the end id.
    """
    held = spark.read.parquet(f"{path}/blocks").join(
        spark.read.parquet(f"{path}/shards").select("shard", "tokens_before", "bits"), "shard"
    )

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack(row["payload"], row["bits"], 0, row["n_ids"])
                starts = np.array(row["doc_starts"] + [row["n_ids"]], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(starts[:-1] + row["tokens_before"] + row["first_token"]),
                        pa.array(np.diff(starts)),
                        ragged.binaries(ids.astype("<u4"), 4 * starts),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    return held.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def read_document(spark: SparkSession, path: str, doc_id: int) -> list[np.ndarray]:
    """Ids of the documents with one id, unpacked from their own bits alone."""
    found = (
        spark.read.parquet(f"{path}/blocks")
        .filter(F.array_contains("doc_ids", F.lit(doc_id)))
        .join(spark.read.parquet(f"{path}/shards").select("shard", "bits"), "shard")
        .orderBy("shard", "block")
    )
    out = []
    for row in found.toLocalIterator():
        ends = [*row.doc_starts[1:], row.n_ids]
        for own, start, end in zip(row.doc_ids, row.doc_starts, ends):
            if own == doc_id:
                out.append(unpack(bytes(row.payload), row.bits, start, end - start))
    return out
