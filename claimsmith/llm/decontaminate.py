"""Benchmark decontamination with one FM-index per training shard.

A task cuts the documents it reads into shards of about a million words,
builds an FM-index over each shard's word ids, backward-searches every
benchmark window in it, locates the occurrences by sampled suffix positions
and merges them into removal spans per document. Documents are never
shuffled: the index is built where the text is read. Words that no benchmark
item has share one id, which no window contains.

The benchmark is the query set. Its distinct items are cut into pieces that
overlap by one word less than a window, and the pieces form blocks of about
``BLOCK_BYTES``. Only one block is on the driver and in the tasks at a time:
its spans are written to a scratch table under the digest of the text before
the next block is read, and the tables are merged per text. Memory is bounded
by the block; each block costs one scan of the documents and their indexes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimsmith.llm.common import Scratch, Shared, free_name, utf8
from claimsmith.llm.fm_index import FmIndex

WINDOW = 13
SHARD_WORDS = 1 << 20
BLOCK_BYTES = 8 << 20
#: Words of an item's piece; windows searched at once.
PIECE_WORDS, PATTERNS = 1 << 16, 1 << 16
_OTHER = 1

#: Word bytes are digits, a-z and everything beyond ASCII; A-Z become a-z.
_WORD_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
                    for b in range(256))

WORD_RE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

RESULT = "struct<n_words bigint, starts array<bigint>, ends array<bigint>, items array<string>>"


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_WORD_TABLE).split()


class Windows:
    """The distinct windows of a block of benchmark items: one stream of word
    ids, the places where windows begin, and the items each belongs to."""

    def __init__(self, items: list[tuple[str | None, bytes | None]], width: int = WINDOW):
        self.ids: dict[bytes, int] = {}
        texts = [np.array([self.ids.setdefault(w, len(self.ids) + _OTHER + 1) for w in words_of(t)], np.int32) for _, t in items]
        self.names = sorted({item for item, _ in items if item is not None})
        name = {n: i for i, n in enumerate(self.names)}
        self.stream = np.concatenate([np.zeros(0, np.int32), *texts])
        self.sigma = len(self.ids) + _OTHER + 1
        size = np.array([min(width, len(t)) for t in texts], np.int64)
        count = np.array([len(t) for t in texts], np.int64) - size + 1
        begin = np.cumsum([0, *map(len, texts)])[:-1]
        owner = np.array([name.get(item, -1) for item, _ in items], np.int64)  # an item without a name hits, too
        self.longest = int(size.max(initial=1)) or 1
        runs, length = {1: self.stream.astype(np.int64)}, 1
        while 2 * length <= self.longest:  # equal numbers: equal runs of that many words
            runs[2 * length] = self._number(runs[length][:-length], runs[length][length:])
            length *= 2
        self.by_length = []
        for n in np.unique(size[size > 0]):
            own = np.flatnonzero(size == n)
            starts = np.concatenate([begin[i] + np.arange(count[i]) for i in own])
            whose = np.repeat(owner[own], count[own])
            half = 1 << (int(n).bit_length() - 1)  # two runs that overlap tell a window whole
            window = self._number(runs[half][starts], runs[half][starts + n - half])
            _, first = np.unique(window, return_index=True)
            pairs = np.unique(window * (len(self.names) + 1) + whose + 1)
            window, whose = np.divmod(pairs, len(self.names) + 1)
            window, whose = window[whose > 0], whose[whose > 0] - 1
            self.by_length.append((int(n), starts[first], np.searchsorted(window, np.arange(len(first) + 1)), whose))

    @staticmethod
    def _number(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return np.unique(left << 32 | right, return_inverse=True)[1].astype(np.int64)

    def patterns(self, size: int, starts: np.ndarray) -> np.ndarray:
        return self.stream[starts[:, None] + np.arange(size)].astype(np.int64)

    def symbols(self, words: list[bytes]) -> np.ndarray:
        get = self.ids.get
        return np.array([get(w, _OTHER) for w in words], np.int64)


def _search_shard(pieces: list[np.ndarray], windows: Windows) -> list[tuple[np.ndarray, np.ndarray, set[int]]]:
    """Merged spans and occurring items of each piece of one shard."""
    starts = np.cumsum([0, *(len(p) + 1 for p in pieces)])
    text = np.zeros(starts[-1], np.int64)
    for at, p in zip(starts, pieces):
        text[at:at + len(p)] = p
    index = FmIndex(text, windows.sigma)
    edges, items = np.zeros(len(text) + 1, np.int64), [set() for _ in pieces]
    for size, begins, cuts, whose in windows.by_length:
        for at in range(0, len(begins), PATTERNS):
            lo, hi = index.search(windows.patterns(size, begins[at:at + PATTERNS]))
            which = np.repeat(np.arange(len(lo)), hi - lo)
            if not len(which):
                continue
            rows = np.arange(len(which)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + lo[which]
            places = index.locate(rows)
            np.add.at(edges, places, 1)
            np.add.at(edges, places + size, -1)
            piece = np.searchsorted(starts, places, side="right") - 1
            for p, w in np.unique(np.stack([piece, which + at]), axis=1).T:
                items[p].update(whose[cuts[w]:cuts[w + 1]].tolist())
    covered = np.concatenate([[False], np.cumsum(edges)[:-1] > 0, [False]])
    change = np.flatnonzero(covered[1:] != covered[:-1])
    first, last = change[::2], change[1::2]
    piece = np.searchsorted(starts, first, side="right") - 1
    cut = np.searchsorted(piece, np.arange(len(pieces) + 1))
    return [(first[a:b] - at, last[a:b] - at, items[i]) for i, (a, b, at) in enumerate(zip(cut, cut[1:], starts))]


def merge_spans(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans that overlap or touch become one; ascending."""
    if not len(starts):
        return starts, ends
    by = np.argsort(starts, kind="stable")
    starts, reach = starts[by], np.maximum.accumulate(ends[by])
    new = np.concatenate([[True], starts[1:] > reach[:-1]])
    return starts[new], np.concatenate([reach[:-1][new[1:]], reach[-1:]])


def scan(texts: Iterator[pd.Series], windows: Windows, shard_words: int = SHARD_WORDS) -> Iterator[pd.DataFrame]:
    """A result row for each text, in order. A document longer than a shard
    is searched in pieces that overlap by one word less than a window."""
    waiting: list[tuple[int, list[tuple[int, int]]]] = []  # words, (piece, its offset)
    pieces: list[np.ndarray] = []
    held = 0

    def flush() -> pd.DataFrame:
        found = _search_shards(pieces, windows, shard_words)
        rows = []
        for n, parts in waiting:
            starts = np.concatenate([found[p][0] + at for p, at in parts])
            ends = np.concatenate([found[p][1] + at for p, at in parts])
            starts, ends = merge_spans(starts, ends)
            own = sorted(set().union(*(found[p][2] for p, _ in parts)))  # names are in order
            rows.append((n, starts.tolist(), ends.tolist(), [windows.names[i] for i in own]))
        waiting.clear()
        pieces.clear()
        return pd.DataFrame(rows, columns=["n_words", "starts", "ends", "items"])

    for batch in texts:
        for text in batch:
            symbols = windows.symbols(words_of(text))
            parts = []
            for at in range(0, max(1, len(symbols)), shard_words):
                parts.append((len(pieces), at))
                pieces.append(symbols[at:at + shard_words + windows.longest - 1])
            waiting.append((len(symbols), parts))
            held += len(symbols)
            if held >= shard_words:
                yield flush()
                held = 0
    if waiting:
        yield flush()


def _search_shards(pieces: list[np.ndarray], windows: Windows, shard_words: int) -> list:
    """Pieces in shards of at most about shard_words (one piece at least)."""
    found, i = [], 0
    while i < len(pieces):
        j, held = i, 0
        while j < len(pieces) and (j == i or held + len(pieces[j]) + 1 <= shard_words + windows.longest):
            held += len(pieces[j]) + 1
            j += 1
        found += _search_shard(pieces[i:j], windows)
        i = j
    return found


def _spans_column(text: str, windows) -> Column:
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        yield from scan(batches, windows.value)

    return F.pandas_udf(run, RESULT)(utf8(text))


def _merge(starts: pd.Series, ends: pd.Series) -> pd.DataFrame:
    both = [merge_spans(np.array(s, np.int64), np.array(e, np.int64)) for s, e in zip(starts, ends)]
    return pd.DataFrame({"starts": [s.tolist() for s, _ in both], "ends": [e.tolist() for _, e in both]})


def _cut_items(width: int):
    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for item, text in zip(frame["item"], frame["text"]):
                words = words_of(text)
                parts = [b" ".join(words[at:at + PIECE_WORDS + width - 1])
                         for at in range(0, max(1, len(words) - width + 1), PIECE_WORDS) if words]
                yield pd.DataFrame({"item": pd.Series([item] * len(parts), dtype=object), "text": parts})

    return cut


def _found_in_blocks(docs: DataFrame, text_col: str, scratch: Scratch, block, blocks: int) -> DataFrame:
    """(key, starts, ends, items) of the texts with a hit; key is the text's
    digest. One block after the other: a table is written and the block
    released before the next is read."""
    text = docs.select(utf8(text_col).alias("text"))
    tables = []
    for k in range(blocks):
        windows = Shared(docs.sparkSession, block(k))
        marked = text.select(F.sha2("text", 256).alias("key"), _spans_column("text", windows).alias("m"))
        tables.append(scratch.write(marked.where(F.size("m.starts") > 0).select("key", F.lit(k).alias("block"), "m"))[0])
        windows.destroy()
    found = tables[0]
    for more in tables[1:]:
        found = found.unionByName(more)
    # Copies of a text have the same spans; what is left of a text is a row per block.
    own = found.groupBy("key", "block").agg(F.first("m").alias("m")).groupBy("key").agg(F.collect_list("m").alias("m"))
    merged = F.pandas_udf(_merge, "struct<starts array<bigint>, ends array<bigint>>")
    return scratch.write(own.select(
        "key", merged(F.flatten("m.starts"), F.flatten("m.ends")).alias("s"),
        F.array_sort(F.array_distinct(F.flatten("m.items"))).alias("items")
    ).select("key", "s.starts", "s.ends", "items"))[0]


def mark_contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", out: str = "contamination",
                       width: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents with a struct column ``out``: n_words, n_hit, the merged
    spans ``starts`` / ``ends`` (word positions, end exclusive), and ``items``
    (sorted ids, as strings, of the items with an occurring window).

    Null and empty texts have no words and no spans. Benchmark rows
    without words have no windows; those without an id hit, but add nothing to
    ``items``; repeated rows count once. All
    other columns of the documents pass through unread, whatever their names;
    an existing column named like ``out`` is replaced.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "benchmark")
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), utf8("text").alias("text")).where(
        "text is not null").distinct()
    pieces, _ = scratch.write(items.mapInPandas(_cut_items(width), "item string, text binary"))
    total = pieces.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))

    def block(k: int) -> Windows:
        own = pieces.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k)
        return Windows([(r["item"], bytes(r["text"])) for r in own.toLocalIterator()], width)

    taken = [*docs.columns, out]
    mark = free_name(taken, "mark")
    if blocks == 1:
        docs = docs.withColumn(mark, _spans_column(text_col, Shared(spark, block(0))))
        extra = [mark]
        n_words, starts, ends, names = (F.col(f"{mark}.{f}") for f in ("n_words", "starts", "ends", "items"))
    else:
        extra = [mark, free_name([*taken, mark], "key")]
        found = _found_in_blocks(docs, text_col, scratch, block, blocks).select(
            F.col("key").alias(extra[1]), F.struct("starts", "ends", "items").alias(mark))
        docs = docs.join(found, F.sha2(utf8(text_col), 256) == F.col(extra[1]), "left")
        n_words = F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD_RE)), F.lit(0)).cast("bigint")
        starts, ends = (F.coalesce(f"{mark}.{f}", F.array().cast("array<bigint>")) for f in ("starts", "ends"))
        names = F.coalesce(f"{mark}.items", F.array().cast("array<string>"))
    hit = F.aggregate(F.zip_with(starts, ends, lambda s, e: e - s), F.lit(0).cast("bigint"), lambda a, x: a + x)
    return docs.withColumn(out, F.struct(n_words.alias("n_words"), hit.alias("n_hit"), starts.alias("starts"),
                                         ends.alias("ends"), names.alias("items"))).drop(*extra)


def is_contaminated(mark: str = "contamination") -> Column:
    """At least one word in twenty lies inside an occurrence."""
    return (F.col(f"{mark}.n_hit") > 0) & (F.col(f"{mark}.n_hit") * 20 >= F.col(f"{mark}.n_words"))
