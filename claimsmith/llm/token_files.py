"""Token-id files of shuffled planes.

Documents are range-partitioned and sorted by id; each partition (a shard)
encodes its documents in order and cuts its id stream into chunks at document
ends. A chunk row is self-contained: the ids of its documents in blocks of
``BLOCK_IDS``, each block's 32-bit ids transposed into byte planes (or bit
planes) and each plane compressed with zstandard, the sizes of the planes
(the chunk's index), and its documents with their lengths. Chunks are written
by Spark as a table (uncompressed Parquet, as the planes are compressed
already), so any store works and a lost task writes its chunks again. A chunk
can be read without its neighbours; the position of a document in the whole
stream is its position in the shard plus the ids of the shards before, of
which there is one number per shard.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimsmith.operators.keys import bounded_broadcast, scratch_table_path

BLOCK_IDS = 1 << 16
CHUNK_IDS = 1 << 20
#: Bytes of text for one task; a task keeps the pieces it has seen.
SHARD_BYTES = 64 << 20
END_ID = 0
_BATCH_CHARS = 2 << 20
_CACHE_PIECES = 150_000
_CACHE_CHARS = 48

CHUNK_SCHEMA = ("shard int, chunk int, first bigint, n_ids bigint, planes int, block_ids int, plane_sizes array<int>, "
                "doc_ids array<bigint>, n_tokens array<bigint>, payload binary")


def _to_planes(ids: np.ndarray, planes: int) -> np.ndarray:
    """ids (uint32) as rows of planes: 4 byte planes or 32 bit planes."""
    as_bytes = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if planes == 4:
        return np.ascontiguousarray(as_bytes.T)
    bits = np.unpackbits(as_bytes, axis=1, bitorder="little")
    return np.packbits(bits.T, axis=1, bitorder="little")


def _from_planes(rows: np.ndarray, n: int) -> np.ndarray:
    if len(rows) == 4:
        as_bytes = rows.T
    else:
        as_bytes = np.packbits(np.unpackbits(rows, axis=1, count=n, bitorder="little").T, axis=1, bitorder="little")
    return np.ascontiguousarray(as_bytes).view("<u4").ravel()


def pack_ids(ids: np.ndarray, planes: int = 4, block_ids: int = BLOCK_IDS) -> tuple[bytes, list[int]]:
    """The compressed planes of each block, one after the other, and their sizes."""
    squeeze = zstandard.ZstdCompressor(level=1)
    frames = [squeeze.compress(row.tobytes()) for at in range(0, len(ids), block_ids)
              for row in _to_planes(ids[at:at + block_ids], planes)]
    return b"".join(frames), [len(f) for f in frames]


def unpack_ids(payload: bytes, sizes: list[int], n: int, planes: int = 4, block_ids: int = BLOCK_IDS) -> np.ndarray:
    expand, ends = zstandard.ZstdDecompressor(), np.cumsum([0, *sizes])
    view, out = memoryview(payload), np.empty(n, np.uint32)
    for block, at in enumerate(range(0, n, block_ids)):
        size = min(block_ids, n - at)
        rows = [np.frombuffer(expand.decompress(view[ends[i]:ends[i + 1]]), np.uint8)
                for i in range(block * planes, (block + 1) * planes)]
        out[at:at + size] = _from_planes(np.stack(rows), size)
    return out


def byte_characters() -> dict[int, int]:
    """The character by which a byte-level vocabulary writes each byte: the
    byte's own where it prints, else the next one from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = (b for b in range(256) if b not in own)
    return {b: b for b in own} | {b: 256 + i for i, b in enumerate(rest)}


class Encoder:
    """Texts to ids with a tokenizer file, without adding special tokens.

    A byte-level tokenizer splits a text into pieces and gives each piece's
    bytes to its model, so each distinct piece goes through the library's
    model once and is then looked up. Pieces are kept in two halves: a full
    half becomes the old one, and what is met again moves to the new one, so
    rare pieces go and a task holds a bounded number. Tokenizers that split in
    another way, and texts that hold a special token's string, go through the
    library whole.
    """

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import public_tokenizers
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        split = self.tokenizer.pre_tokenizer
        self.by_piece = (isinstance(split, pre_tokenizers.ByteLevel) and split.use_regex and not split.add_prefix_space
                         and self.tokenizer.normalizer is None)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.pieces = regex.compile(public_tokenizers.PATTERN).findall
        self.model, self.byte_characters = self.tokenizer.model, byte_characters()
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _library(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _model(self, pieces: list[str]) -> Iterator[bytes]:
        tokenize, characters = self.model.tokenize, self.byte_characters
        for piece in pieces:
            tokens = tokenize(piece.encode().decode("latin-1").translate(characters))
            yield array("I", [t.id for t in tokens]).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids as little-endian 32-bit integers."""
        whole = [i for i, t in enumerate(texts) if not self.by_piece or any(s in t for s in self.special)]
        out: list[bytes] = [b""] * len(texts)
        for i, ids in zip(whole, self._library([texts[i] for i in whole])):
            out[i] = ids
        whole = set(whole)
        split = {i: self.pieces(t) for i, t in enumerate(texts) if i not in whole}
        if len(self.known) > _CACHE_PIECES:
            self.old, self.known = self.known, {}
        known, old = self.known, self.old
        new = set().union(*split.values()).difference(known)
        again = old.keys() & new
        known.update((p, old[p]) for p in again)
        new = list(new - again)
        known.update(zip(new, self._model(new)))
        for i, pieces in split.items():
            out[i] = b"".join(map(known.__getitem__, pieces))
        for p in new:
            if len(p) > _CACHE_CHARS:
                del known[p]
        return out


def _chunks(frames: Iterator[pd.DataFrame], tokenizer: str, end_id: int, planes: int) -> Iterator[pd.DataFrame]:
    encoder, end = Encoder(tokenizer), np.array([end_id], "<u4").tobytes()
    shard, chunk, first = TaskContext.get().partitionId(), 0, 0
    docs: list[int | None] = []
    parts: list[bytes] = []
    held = 0

    def close() -> pd.DataFrame:
        ids = np.frombuffer(b"".join(parts), "<u4")
        payload, sizes = pack_ids(ids, planes)
        row = (shard, chunk, first, len(ids), planes, BLOCK_IDS, sizes, list(docs), [len(p) // 4 for p in parts], payload)
        return pd.DataFrame([row], columns=[c.split()[0] for c in CHUNK_SCHEMA.split(", ")])

    for frame in frames:
        names, texts = frame["doc_id"].tolist(), frame["text"].tolist()
        at = 0
        while at < len(texts):
            stop, chars = at, 0
            while stop < len(texts) and (stop == at or chars + len(texts[stop] or "") <= _BATCH_CHARS):
                chars += len(texts[stop] or "")
                stop += 1
            for name, ids in zip(names[at:stop], encoder.encode([t or "" for t in texts[at:stop]])):
                docs.append(None if pd.isna(name) else int(name))
                parts.append(ids + end)
                held += len(parts[-1]) // 4
                if held >= CHUNK_IDS:
                    yield close()
                    chunk, first, held = chunk + 1, first + held, 0
                    docs.clear()
                    parts.clear()
            at = stop
    if docs:
        yield close()


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, planes: int = 4,
                      shard_bytes: int = SHARD_BYTES) -> None:
    """Encode every text and write the chunk table to ``path`` (a shared folder).

    Documents go in ascending doc_id order, null ids first, rows of one id by
    their text's hash. Null texts count as empty; every document ends with
    ``end_id``. An empty table writes no chunks. ``planes``: 4 (bytes) or 32
    (bits). Columns other than doc_id and text are not read.
    """
    if planes not in (4, 32):
        raise ValueError("planes must be 4 or 32")
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.monotonically_increasing_id()]
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-size // shard_bytes))
    keyed = docs.select("*", order[1].alias("h"), order[2].alias("row"))
    sort = [order[0], F.col("h"), F.col("row")]
    ranged = keyed.repartitionByRange(shards, *sort).sortWithinPartitions(*sort).select("doc_id", "text")
    (ranged.mapInPandas(lambda frames: _chunks(frames, tokenizer, end_id, planes), CHUNK_SCHEMA)
     .write.option("compression", "uncompressed").parquet(path))


def _documents(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for c in frame.itertuples(index=False):
            ids = unpack_ids(c.payload, c.plane_sizes, c.n_ids, c.planes, c.block_ids)
            ends = np.cumsum(np.asarray(c.n_tokens, np.int64))
            starts = ends - np.asarray(c.n_tokens, np.int64)
            raw = memoryview(ids.astype("<u4").tobytes())
            yield pd.DataFrame({
                "shard": c.shard, "doc_id": pd.array([None if pd.isna(d) else int(d) for d in c.doc_ids], "Int64"),
                "first": starts + c.first, "n_tokens": ends - starts,
                "ids_crc32": [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(starts, ends)]})


def read_token_index(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""
    chunks = spark.read.schema(CHUNK_SCHEMA).parquet(path)
    # One number per shard; the number of shards is a number of partitions.
    sizes = sorted((r[0], r[1]) for r in chunks.groupBy("shard").agg(F.sum("n_ids")).collect())
    before, offsets = 0, []
    for shard, n in sizes:
        offsets.append((shard, before))
        before += n
    known = spark.createDataFrame(offsets, "of int, before bigint")
    found = chunks.mapInPandas(_documents, "shard int, doc_id bigint, first bigint, n_tokens bigint, ids_crc32 bigint")
    return found.join(bounded_broadcast(known, len(offsets)), F.col("shard") == F.col("of")).select(
        "doc_id", (F.col("before") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, ids) of every document, decoded from the files."""
    def decode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for c in frame.itertuples(index=False):
                ids = unpack_ids(c.payload, c.plane_sizes, c.n_ids, c.planes, c.block_ids).astype(np.int64)
                ends = np.cumsum(np.asarray(c.n_tokens, np.int64))
                yield pd.DataFrame({"doc_id": pd.array([None if pd.isna(d) else int(d) for d in c.doc_ids], "Int64"),
                                    "ids": [ids[a:b].tolist() for a, b in zip([0, *ends[:-1]], ends)]})

    return spark.read.schema(CHUNK_SCHEMA).parquet(path).mapInPandas(decode, "doc_id bigint, ids array<bigint>")


def encode_and_index(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Write the files of ``docs`` to a fresh table in the shared folder and read its index."""
    spark = docs.sparkSession
    path = scratch_table_path(spark, "token-files")
    write_token_files(docs, path, tokenizer, end_id)
    return read_token_index(spark, path)
