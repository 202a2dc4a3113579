"""How the sources of a language differ in their terms, from an index built in one pass.

1. Blocks. A task reads its documents once and counts terms in memory: per
   (lang, source) the occurrences, per lang the documents. When a block holds
   ``BLOCK_POSTINGS`` postings it is spilled as a run: its terms in order, cut
   by hash into shards. Runs are rows of a written table, so a lost executor
   costs its own tasks only.
2. Merge. The runs of a (lang, shard) are merged by a heap of their next
   terms. Terms in too few documents end there; the others leave one row with
   their count in every source. More than ``FAN_IN`` runs are merged in
   several rounds, so a task holds a bounded number of run slices.
3. Pair corrections. The divergence of two sources is a sum over all kept
   terms, most of which neither source holds. So it starts as if no term
   occurred in either (a number per pair) and is corrected by the terms that
   occur: one correction for each distinct count of a source against every
   other source's empty share, and one for each two sources in a term's row.
   Corrections are streamed over the merged rows in blocks of bounded size
   and summed per pair; nothing is kept per term and pair.

All arithmetic is in integers. Shares are billionths, so squares of their
differences fit in 64 bits; a share is a long division in three digits of 1000.
"""

from __future__ import annotations

import heapq
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimsmith.llm.common import Scratch

MIN_DOCUMENTS = 10
TOP_TERMS = 10
SCALE = 1_000_000_000
#: Postings (lang, source, term) and (lang, term) that a task's block holds in memory.
BLOCK_POSTINGS = 400_000
#: Bytes of text for one shard of a language, the most shards, and the runs merged at once.
SHARD_BYTES, MOST_SHARDS = 32 << 20, 1 << 14
FAN_IN = 512
_SLICE_TERMS = 4096
_WORD_BLOCK = 1 << 20
_CELLS = 1 << 20

#: Bytes of terms as they are, A-Z lowered, all others a space.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))

RUN_SCHEMA = ("lang string, shard int, run bigint, seq int, terms array<binary>, documents array<bigint>, "
              "ends array<bigint>, names array<string>, sources array<int>, counts array<bigint>")


def term_blocks(raw: bytes, size: int = _WORD_BLOCK) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text, in lists of about ``size`` bytes: runs of
    letters a-z (A-Z lowered) and characters beyond ASCII."""
    clean, start = raw.translate(_TERM_BYTES), 0
    while start < len(clean):
        end = clean.find(b" ", start + size)
        end = len(clean) if end < 0 else end
        yield clean[start:end].split()
        start = end


class Block:
    """Counts of the documents read since the last spill."""

    def __init__(self):
        self.counts: dict[tuple[str, str], Counter] = defaultdict(Counter)
        self.documents: dict[str, Counter] = defaultdict(Counter)
        self.postings = 0

    def add(self, raw: bytes, lang: str, source: str) -> None:
        counts, documents, distinct = self.counts[lang, source], self.documents[lang], set()
        before = len(counts) + len(documents)
        for terms in term_blocks(raw):
            counts.update(terms)
            distinct.update(terms)
        documents.update(distinct)
        self.postings += len(counts) + len(documents) - before

    def run(self, number: int, shards: int) -> Iterator[pa.RecordBatch]:
        """The block's postings in the order of their terms, by lang and shard."""
        for lang, documents in self.documents.items():
            terms = sorted(documents)
            shard = np.fromiter(map(crc32, terms), np.int64, len(terms)) % shards
            by_shard = np.argsort(shard, kind="stable")
            terms = [terms[i] for i in by_shard.tolist()]
            place = dict(zip(terms, range(len(terms))))
            names = sorted(s for of, s in self.counts if of == lang)
            own = [self.counts[lang, s] for s in names]
            of_term = np.fromiter((place[t] for c in own for t in c), np.int64)
            counts = np.fromiter((n for c in own for n in c.values()), np.int64, len(of_term))
            sources = np.repeat(np.arange(len(own), dtype=np.int32), [len(c) for c in own])
            order = np.argsort(of_term, kind="stable")
            ends = np.cumsum(np.bincount(of_term, minlength=len(terms)))
            found = np.fromiter(map(documents.__getitem__, terms), np.int64, len(terms))
            cuts = np.searchsorted(shard[by_shard], np.arange(shards + 1)).tolist()
            for k in range(shards):
                for seq, at in enumerate(range(cuts[k], cuts[k + 1], _SLICE_TERMS)):
                    stop = min(at + _SLICE_TERMS, cuts[k + 1])
                    first = int(ends[at - 1]) if at else 0
                    held = order[first:ends[stop - 1]]
                    yield _row(lang, k, number, seq, terms[at:stop], found[at:stop], ends[at:stop] - first,
                               names, sources[held], counts[held])


def _row(lang, shard, run, seq, terms, documents, ends, names, sources, counts) -> pa.RecordBatch:
    """One slice: terms in order, the documents that hold each, the end of
    each one's postings, and the postings as (place in names, count)."""
    def listed(values, kind):
        return pa.array([values], pa.list_(kind))

    return pa.RecordBatch.from_arrays(
        [pa.array([lang]), pa.array([shard], pa.int32()), pa.array([run], pa.int64()), pa.array([seq], pa.int32()),
         listed(terms, pa.binary()), listed(documents, pa.int64()), listed(ends, pa.int64()), listed(names, pa.string()),
         listed(sources, pa.int32()), listed(counts, pa.int64())],
        [c.split()[0] for c in RUN_SCHEMA.split(", ")])


def spill_runs(docs: DataFrame, shards: int, block_postings: int = BLOCK_POSTINGS) -> DataFrame:
    """Runs (RUN_SCHEMA) of (raw, lang, source) rows."""
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, block = TaskContext.get().partitionId() << 20, Block()
        for batch in batches:
            langs, sources = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for raw, lang, source in zip(batch.column(0), langs, sources):
                block.add(raw.as_py(), lang, source)
                if block.postings >= block_postings:
                    yield from block.run(number, shards)
                    number, block = number + 1, Block()
        yield from block.run(number, shards)

    return docs.mapInArrow(index, RUN_SCHEMA)


class RunSlices:
    """The slices of several runs of one (lang, shard), merged term by term."""

    def __init__(self, rows: pa.Table):
        self.rows = rows = rows.combine_chunks()
        names = rows["names"].to_pylist()
        self.names = sorted(set().union(*names))
        index = {s: i for i, s in enumerate(self.names)}
        sizes, postings = ([len(x) for x in rows[c]] for c in ("terms", "sources"))
        self.base = np.cumsum([0, *sizes]).tolist()
        starts = np.cumsum([0, *postings])
        self.ends = np.concatenate([e.values.to_numpy() + s for e, s in zip(rows["ends"], starts)])
        self.begins = np.concatenate([[0], self.ends[:-1]])
        self.sources = np.concatenate([np.array([index[s] for s in own], np.int64)[of.values.to_numpy()]
                                       for own, of in zip(names, rows["sources"])])
        self.counts = np.concatenate([c.values.to_numpy() for c in rows["counts"]])

    def _stream(self, order: list[int]) -> Iterator[tuple[bytes, int, int]]:
        """(term, its place among all slices, documents) of a run, its slices one after the other."""
        for i in order:
            terms, documents = self.rows["terms"][i].as_py(), self.rows["documents"][i].as_py()
            yield from zip(terms, range(self.base[i], self.base[i + 1]), documents)

    def merged(self, least: int) -> Iterator[tuple[list[bytes], list[int], np.ndarray, np.ndarray, np.ndarray]]:
        """In parts of ``_SLICE_TERMS``: terms in at least ``least`` documents
        in order, their documents, and their postings: ends, sources, counts."""
        runs = defaultdict(list)
        for i, (run, seq) in enumerate(zip(self.rows["run"].to_pylist(), self.rows["seq"].to_pylist())):
            runs[run].append((seq, i))
        streams = [self._stream([i for _, i in sorted(order)]) for order in runs.values()]
        terms, documents, of_term, places = [], [], [], []
        for term, found in groupby(heapq.merge(*streams), key=itemgetter(0)):
            found = list(found)
            n = sum([f[2] for f in found])
            if n < least:
                continue
            of_term += [len(terms)] * len(found)
            places += [f[1] for f in found]
            terms.append(term)
            documents.append(n)
            if len(terms) == _SLICE_TERMS:
                yield terms, documents, *self._postings(np.array(of_term), np.array(places))
                terms, documents, of_term, places = [], [], [], []
        if terms:
            yield terms, documents, *self._postings(np.array(of_term), np.array(places))

    def _postings(self, of_term: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The postings at some places, those of one term and source summed."""
        sizes, n = self.ends[places] - self.begins[places], len(self.names)
        held = np.repeat(self.begins[places] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        key = np.repeat(of_term, sizes) * n + self.sources[held]
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        ends = np.cumsum(np.bincount(key[first] // n, minlength=int(of_term[-1]) + 1))
        return ends, key[first] % n, np.add.reduceat(self.counts[held][order], first)


def merge_runs(runs: DataFrame, n_runs: int, fan_in: int = FAN_IN) -> DataFrame:
    """The runs, in as many rounds as it takes until at most ``fan_in`` are left."""
    scratch = Scratch(runs.sparkSession, "divergence-merge")

    def merged(key: tuple, rows: pa.Table) -> pa.Table:
        held = RunSlices(rows)
        lang, shard, run = (k.as_py() for k in key)
        return pa.Table.from_batches([_row(lang, shard, run, seq, terms, documents, ends, held.names, sources, counts)
                                      for seq, (terms, documents, ends, sources, counts) in enumerate(held.merged(0))])

    path = None
    while n_runs > fan_in:
        n_runs = -(-n_runs // fan_in)
        group = F.pmod(F.xxhash64("run"), F.lit(n_runs)).alias("of")
        done = path
        runs, path = scratch.write(runs.withColumn("of", group).groupBy("lang", "shard", "of").applyInArrow(merged, RUN_SCHEMA))
        if done:
            scratch.drop(done)
    return runs


def frequencies(runs: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """(lang, shard, term, total, sources, counts): the kept terms with their count in every source that has them."""
    names = ["lang", "shard", "term", "total", "sources", "counts"]

    def kept(key: tuple, rows: pa.Table) -> pa.Table:
        held, batches = RunSlices(rows), []
        for terms, _, ends, sources, counts in held.merged(min_documents):
            offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
            total = np.add.reduceat(counts, np.concatenate([[0], ends[:-1]]))
            batches.append(pa.RecordBatch.from_arrays([
                pa.repeat(key[0], len(terms)), pa.repeat(key[1], len(terms)), pa.array(terms, pa.binary()).cast(pa.string()),
                pa.array(total), pa.ListArray.from_arrays(offsets, pa.array(held.names, pa.string()).take(pa.array(sources))),
                pa.ListArray.from_arrays(offsets, pa.array(counts))], names))
        empty = pa.schema([("lang", pa.string()), ("shard", pa.int32()), ("term", pa.string()), ("total", pa.int64()),
                           ("sources", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])
        return pa.Table.from_batches(batches) if batches else empty.empty_table()

    return runs.groupBy("lang", "shard").applyInArrow(
        kept, "lang string, shard int, term string, total bigint, sources array<string>, counts array<bigint>")


def share(counts: np.ndarray, mass: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE (counts + 2) / mass) for counts + 2 <= mass, digit by digit."""
    rest, out = counts + 2, np.zeros(np.broadcast(counts, mass).shape, np.int64)
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // mass
        rest = rest % mass
    return out + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def _summed(a: np.ndarray, b: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums of ``value`` by unordered pair of sources, the smaller first."""
    pair = np.minimum(a, b) * n + np.maximum(a, b)
    order = np.argsort(pair, kind="stable")
    pair = pair[order]
    first = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
    return pair[first] // n, pair[first] % n, np.add.reduceat(value[order], first)


def corrections(sources: np.ndarray, ends: np.ndarray, counts: np.ndarray, mass: np.ndarray,
                cells: int = _CELLS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(a, b, value) in parts: what the terms of some rows add to the
    divergence of sources a < b, taken as if none of them occurred in either.
    ``sources`` and ``counts`` are the rows' postings, sources ascending in a
    row; ``ends`` the rows' last places."""
    n = len(mass)
    if not len(counts) or n < 2:
        return
    empty = share(np.zeros(n, np.int64), mass)
    p, none = share(counts, mass[sources]), empty[sources]
    # A source's count against the empty share of each other source.
    distinct, times = np.unique(np.stack([sources, p]), axis=1, return_counts=True)
    step = max(1, cells // n)
    for at in range(0, distinct.shape[1], step):
        a, q = distinct[:, at:at + step]
        more = divergence(q[:, None], empty) - divergence(empty[a][:, None], empty)
        first = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
        sums = np.add.reduceat(more * times[at:at + step, None], first)
        left, right = np.repeat(a[first], n), np.tile(np.arange(n), len(first))
        other = left != right
        yield _summed(left[other], right[other], sums.ravel()[other], n)
    # Two sources in one row: each place with those after it.
    partners = np.repeat(ends, np.diff(ends, prepend=0)) - np.arange(len(counts)) - 1
    made = np.cumsum(partners)
    at = 0
    while at < len(counts):
        stop = max(at + 1, int(np.searchsorted(made, (made[at - 1] if at else 0) + cells, side="right")))
        left = np.repeat(np.arange(at, stop), partners[at:stop])
        right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(partners[at:stop]) - partners[at:stop], partners[at:stop])
        if len(left):
            pl, pr, nl, nr = p[left], p[right], none[left], none[right]
            yield _summed(sources[left], sources[right],
                          divergence(pl, pr) - divergence(pl, nr) - divergence(nl, pr) + divergence(nl, nr), n)
        at = stop


def pair_corrections(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, a, b, correction) for sources a < b, from kept terms and groups
    (lang, source, mass). Each shard of a language meets that language's groups."""
    def corrected(key: tuple, rows: pa.Table, own: pa.Table) -> pa.Table:
        names = np.array(own["source"].to_pylist(), object)
        order = np.argsort(names)  # by code point, as in a row of kept terms
        names, mass = names[order], own["mass"].to_numpy()[order]
        index = {s: i for i, s in enumerate(names)}
        held = rows.combine_chunks()
        ends = np.cumsum([len(c) for c in held["sources"]]).astype(np.int64)
        sources = np.array([index[s] for row in held["sources"].to_pylist() for s in row], np.int64)
        counts = np.array([n for row in held["counts"].to_pylist() for n in row], np.int64)
        parts = list(corrections(sources, ends, counts, mass))
        a, b, value = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.int64),) * 3
        if len(a):
            a, b, value = _summed(a, b, value, len(names))
        return pa.table({"lang": pa.array([key[0].as_py()] * len(a), pa.string()), "a": pa.array(names[a], pa.string()),
                         "b": pa.array(names[b], pa.string()), "correction": pa.array(value, pa.int64())})

    everywhere = terms.select(F.col("lang").alias("of_lang"), F.col("shard").alias("of_shard")).distinct().join(
        groups.select(F.col("lang").alias("l"), F.col("source"), "mass"), F.col("of_lang") == F.col("l")).drop("l")
    parts = terms.select("lang", "shard", "sources", "counts").groupBy("lang", "shard").cogroup(
        everywhere.groupBy("of_lang", "of_shard")).applyInArrow(corrected, "lang string, a string, b string, correction bigint")
    return parts.groupBy("lang", "a", "b").agg(F.sum("correction").alias("correction"))


def _share_sql(count: str, mass: str) -> str:
    return f"1 + (cast({count} + 2 as decimal(28,0)) * {SCALE}) div {mass}"


def _divergence_sql(p: str, q: str) -> str:
    return f"({p} - {q}) * ({p} - {q}) div ({p} + {q})"


def term_index(docs: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """(lang, shard, term, total, sources, counts) of the terms of (raw, lang, source) rows."""
    scratch = Scratch(docs.sparkSession, "divergence")
    size = docs.agg(F.sum(F.octet_length("raw"))).first()[0] or 0
    runs, path = scratch.write(spill_runs(docs, min(MOST_SHARDS, max(1, -(-size // SHARD_BYTES)))))
    merged = merge_runs(runs, runs.select("run").distinct().count())
    terms, _ = scratch.write(frequencies(merged, min_documents))
    scratch.drop(path)
    return terms


def group_totals(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(lang, source, kept, mass, lang_mass) of every occurring (lang, source):
    the lang's kept terms, and occurrences plus two for each kept term."""
    counts = terms.select(F.col("lang").alias("l"), F.explode(F.arrays_zip("sources", "counts")).alias("x"))
    own = counts.groupBy("l", F.col("x.sources").alias("s")).agg(F.sum("x.counts").alias("n"))
    langs = terms.groupBy(F.col("lang").alias("of")).agg(F.count(F.lit(1)).alias("kept"), F.sum("total").alias("lang_n"))
    groups = docs.select("lang", "source").distinct()
    joined = groups.join(own, (groups["lang"] == own["l"]) & (groups["source"] == own["s"]), "left").join(
        langs, groups["lang"] == langs["of"], "left")
    kept, n, lang_n = (F.coalesce(c, F.lit(0)) for c in ("kept", "n", "lang_n"))
    return joined.select("lang", "source", kept.alias("kept"), (n + 2 * kept).alias("mass"), (lang_n + 2 * kept).alias("lang_mass"))


def pair_divergence(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) for every two sources of a lang, both ways."""
    a = groups.select("lang", F.col("source").alias("a"), "kept", F.col("mass").alias("mass_a"))
    b = groups.select("lang", F.col("source").alias("b"), F.col("mass").alias("mass_b"))
    pairs = a.join(b, "lang").where("a < b")  # rows of the result
    shares = pairs.withColumns({c: F.expr(f"case when kept > 0 then {_share_sql('0', m)} end")
                                for c, m in (("p", "mass_a"), ("q", "mass_b"))})
    none = F.expr(f"case when kept > 0 then kept * ({_divergence_sql('p', 'q')}) else 0 end")
    found = shares.join(pair_corrections(terms, groups), ["lang", "a", "b"], "left").select(
        "lang", "a", "b", (none + F.coalesce("correction", F.lit(0))).alias("value"))
    both = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                             F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    return found.select("lang", both.alias("x"), "value").select("lang", "x.source", "x.item", "value")


def term_divergence(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) for kept terms that a source has with a larger share than its lang."""
    rows = terms.select("lang", "term", "total", F.explode(F.arrays_zip("sources", "counts")).alias("x")).select(
        "lang", "term", "total", F.col("x.sources").alias("source"), F.col("x.counts").alias("n"))
    shares = rows.join(groups, ["lang", "source"]).withColumns(
        {"p": F.expr(_share_sql("n", "mass")), "q": F.expr(_share_sql("total", "lang_mass"))})
    return shares.where("p > q").select("lang", "source", F.col("term").alias("item"),
                                        F.expr(_divergence_sql("p", "q")).alias("value"))


def source_divergence(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, top_terms: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): the divergences of every
    source from the others of its lang (part ``pair``), and the ``top_terms``
    terms that set it apart from its lang (part ``term``).

    Null text, lang and source count as empty strings. Every row is a
    document, repeated rows and rows of one id too. A lang whose terms are all
    rare keeps none: its pairs have value 0 and it has no terms. A lang of one
    source has no pairs. Ranks go by value, larger first, ties by the item's
    UTF-8 bytes. An empty table gives no rows. Other columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "divergence")
    plain = docs.select(F.coalesce("text", F.lit("")).cast("binary").alias("raw"),
                        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")])
    terms = term_index(plain, min_documents)
    groups, _ = scratch.write(group_totals(plain, terms))
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    pairs = pair_divergence(terms, groups).withColumn("rank", place)
    tops = term_divergence(terms, groups).withColumn("rank", place).where(F.col("rank") <= top_terms)
    return pairs.withColumn("part", F.lit("pair")).unionByName(tops.withColumn("part", F.lit("term"))).select(
        "lang", "source", "part", "item", "value", "rank")
