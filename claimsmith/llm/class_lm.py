"""Scoring texts with a Brown class-based bigram model.

Counts of all words of the training documents are gathered with partial sums
in each task. The most frequent words, and all endings that group the other
words, are the items of an exchange clustering: each item is moved to the
class that raises the likelihood of the corpus' item bigrams most, until none
moves. The probability of a text is the product of class transitions
(Witten-Bell smoothed) and word emissions (add-one over the words of a class).

Every training word has an item: its own, or that of its ending. Endings are
``ENDING_BYTES`` bytes, so there are at most 65,792 of them, however large the
corpus is; the driver holds the occurring bigrams of items as sparse rows. Then
every training word that shares an item leaves it and takes a class by itself:
the one in which its occurrences are most likely, from the classes of all words
before and after them, which are gathered per word. Transitions and emissions
are counted anew over the classes of the words. The
vocabulary does grow: its most frequent words (at most ``HOT_WORDS``) are
broadcast with their counts and classes, those of all others reach the texts
by a join. A word that training does not know has the class of its item.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimsmith.llm.common import Scratch, Shared, crc32_mod, shuffles_freed, utf8

CORE_WORDS, CLASSES = 512, 48
HOT_WORDS = 200_000
ENDING_BYTES = 2
_FLUSH = 400_000
_HELD_BIGRAMS = 2_000_000
_HELD_NEIGHBOURS = 1_000_000
#: No word holds a line end, so it stands for the end of a text.
END = b"\n"
_SWEEPS = 12


def tokens_of(text: bytes | None) -> list[bytes]:
    """Words with A-Z lowered, then the end."""
    return [*(text or b"").lower().split(), END]


def _count_words(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: Counter[bytes] = Counter()

    def flush() -> pd.DataFrame:
        out = pd.DataFrame({"word": list(counts), "n": np.fromiter(counts.values(), np.int64, len(counts))})
        counts.clear()
        return out

    for frame in frames:
        for text in frame["text"]:
            counts.update(tokens_of(text))
            if len(counts) > _FLUSH:
                yield flush()
    if counts:
        yield flush()


def word_counts(train: DataFrame) -> DataFrame:
    """(word, c) of all tokens of the ``text`` (binary) column."""
    return (train.select("text").mapInPandas(_count_words, "word binary, n bigint")
            .groupBy("word").agg(F.sum("n").alias("c")))


class Items:
    """The things that are clustered: the end, core words, endings, and the rest
    (the last item: words whose ending no training word outside the core has)."""

    def __init__(self, words: list[bytes], endings: list[bytes]):
        words = [END, *(w for w in words if w != END)]
        self.words = {w: i for i, w in enumerate(words)}
        self.endings = {e: len(words) + i for i, e in enumerate(endings)}
        self.rest = len(words) + len(endings)
        self.size = self.rest + 1

    def of(self, tokens: list[bytes]) -> np.ndarray:
        word, ending, rest = self.words.get, self.endings.get, self.rest
        found = [word(t, -1) for t in tokens]
        return np.array([i if i >= 0 else ending(t[-ENDING_BYTES:], rest) for i, t in zip(found, tokens)], np.int64)


def choose_items(counts: DataFrame, core: int = CORE_WORDS, endings: int | None = None) -> Items:
    """The ``core`` most frequent words and the endings of all others, most
    frequent first; a number of ``endings`` leaves those after it to the rest."""
    top = [bytes(r["word"]) for r in counts.orderBy(F.desc("c"), "word").limit(core).select("word").collect()]
    known = Shared(counts.sparkSession, frozenset([*top, END]))

    def ending(words: pd.Series) -> pd.Series:
        return pd.Series([None if w in known.value else w[-ENDING_BYTES:] for w in words], dtype=object)

    by_ending = (counts.select(F.pandas_udf(_typed(ending), "binary")("word").alias("e"), "c").where("e is not null")
                 .groupBy("e").agg(F.sum("c").alias("c")).orderBy(F.desc("c"), "e"))
    if endings is not None:
        by_ending = by_ending.limit(endings)
    return Items(top, [bytes(r["e"]) for r in by_ending.collect()])


def _typed(f):
    f.__annotations__ = {"words": pd.Series, "return": pd.Series}
    return f


class Bigrams:
    """Counts of item pairs, those that occur: ``first`` is followed by
    ``second`` ``n`` times."""

    def __init__(self, size: int, first: np.ndarray, second: np.ndarray, n: np.ndarray):
        self.size, self.first, self.second, self.n = size, first, second, n.astype(np.float64)

    @classmethod
    def of_table(cls, table: np.ndarray) -> "Bigrams":
        first, second = np.nonzero(table)
        return cls(len(table), first, second, table[first, second])

    def totals(self) -> np.ndarray:
        """How often each item is second."""
        return np.bincount(self.second, self.n, self.size)

    def classes(self, of: np.ndarray, classes: int) -> np.ndarray:
        """The counts summed over the classes of both items."""
        return np.bincount(of[self.first] * classes + of[self.second], self.n, classes * classes).reshape(classes, classes)

    def neighbours(self) -> tuple[list, list]:
        """Per item the (items, counts) that follow it, and that it follows."""
        def rows(own, other):
            order = np.argsort(own, kind="stable")
            cuts = np.searchsorted(own[order], np.arange(self.size + 1)).tolist()
            other, n = other[order], self.n[order]
            return [(other[a:b], n[a:b]) for a, b in zip(cuts, cuts[1:])]

        return rows(self.first, self.second), rows(self.second, self.first)


def item_bigrams(train: DataFrame, items: Items) -> Bigrams:
    """How often each item follows each other over all training texts; a text
    begins after an end."""
    shared, size = Shared(train.sparkSession, items), items.size

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[np.ndarray] = []
        n_held = 0

        def flush() -> pd.DataFrame:
            cell, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return pd.DataFrame({"cell": cell, "n": n})

        for frame in frames:
            for text in frame["text"]:
                ids = shared.value.of(tokens_of(text))
                held.append(np.concatenate([[0], ids[:-1]]) * size + ids)
                n_held += len(ids)
                if n_held > _HELD_BIGRAMS:
                    yield flush()
                    n_held = 0
        if held:
            yield flush()

    sums = (train.select("text").mapInPandas(count, "cell bigint, n bigint")
            .groupBy("cell").agg(F.sum("n").alias("n")).toPandas().sort_values("cell"))
    cell = sums["cell"].to_numpy(np.int64)
    return Bigrams(size, cell // size, cell % size, sums["n"].to_numpy(np.int64))


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.where(x > 0, x, 1))


def exchange(bigrams: Bigrams | np.ndarray, classes: int = CLASSES, sweeps: int = _SWEEPS) -> np.ndarray:
    """A class for each item. Item 0 (the end) is class 0 for itself; the
    other items move one by one to the class with the greatest gain."""
    if isinstance(bigrams, np.ndarray):
        bigrams = Bigrams.of_table(bigrams)
    items, totals = bigrams.size, bigrams.totals()
    after, before = bigrams.neighbours()
    classes = max(2, min(classes, items))
    by_count = np.argsort(-totals[1:], kind="stable") + 1
    of = np.zeros(items, np.int64)
    of[by_count] = np.arange(items - 1) % (classes - 1) + 1
    table = bigrams.classes(of, classes)
    for _ in range(sweeps):
        moved = 0
        for w in by_count:
            a = of[w]
            (x, nx), (y, ny) = after[w], before[w]
            own = float(nx[x == w].sum())
            right, left = np.bincount(of[x], nx, classes), np.bincount(of[y], ny, classes)
            right[a] -= own  # its own pairs apart
            left[a] -= own
            table[a] -= right
            table[:, a] -= left
            table[a, a] -= own
            size = table.sum(0)
            diagonal = np.diag(table)
            gain = ((_xlogx(table + right) - _xlogx(table)).sum(1) + (_xlogx(table + left[:, None]) - _xlogx(table)).sum(0))
            gain += (_xlogx(diagonal + right + left + own) + _xlogx(diagonal)
                     - _xlogx(diagonal + right) - _xlogx(diagonal + left))
            gain -= 2 * (_xlogx(size + totals[w]) - _xlogx(size))
            gain[0] = -np.inf
            b = int(np.argmax(gain))
            if gain[b] <= gain[a] + 1e-9:
                b = a
            moved += b != a
            of[w] = b
            table[b] += right
            table[:, b] += left
            table[b, b] += own
        if not moved:
            break
    return of


def transitions(bigrams: Bigrams, of: np.ndarray) -> np.ndarray:
    """log10 P(class | class before), Witten-Bell smoothed with the class' share."""
    classes = int(of.max()) + 1
    table = bigrams.classes(of, classes)
    share = (table.sum(0) + 1) / (table.sum() + classes)
    kinds = (table > 0).sum(1, keepdims=True)
    total = table.sum(1, keepdims=True)
    with np.errstate(invalid="ignore"):
        smooth = np.where(total > 0, (table + kinds * share) / np.maximum(total + kinds, 1), share)
    return np.log10(smooth)


def _neighbour_classes(train: DataFrame, items: Items, of: np.ndarray, classes: int) -> DataFrame:
    """(word, codes, numbers) of the training words that share an item, a part
    of their occurrences a row: how often a word of class ``code`` follows, or
    one of class ``code - classes`` is before."""
    shared, own = Shared(train.sparkSession, (items, of)), len(items.words)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: dict[bytes, int] = {}
        held: list[np.ndarray] = []
        n_held, wide = 0, 2 * classes

        def flush() -> pa.RecordBatch:
            cell, n = np.unique(np.concatenate(held), return_counts=True)
            starts = np.searchsorted(cell, np.arange(len(index) + 1) * wide).astype(np.int32)
            out = pa.RecordBatch.from_arrays(
                [pa.array(list(index), pa.binary()), *(pa.ListArray.from_arrays(starts, x.astype(np.int32)) for x in (cell % wide, n))],
                names=["word", "codes", "numbers"])
            index.clear()
            held.clear()
            return out

        for batch in batches:
            for text in batch.column(0).to_pylist():
                known, cls = shared.value
                tokens = tokens_of(text)
                ids = known.of(tokens)
                at = np.flatnonzero(ids >= own)  # never the end, so each has a word behind it
                if not len(at):
                    continue
                k = cls[ids]
                cell = np.array([index.setdefault(tokens[i], len(index)) for i in at.tolist()], np.int64) * wide
                held += [cell + k[at + 1], cell + classes + np.where(at > 0, k[at - 1], 0)]
                n_held += len(at)
                if n_held > _HELD_NEIGHBOURS:
                    yield flush()
                    n_held = 0
        if held:
            yield flush()

    return train.select("text").mapInArrow(count, "word binary, codes array<int>, numbers array<int>")


def word_classes(train: DataFrame, counts: DataFrame, items: Items, of: np.ndarray, moves: np.ndarray, emission: np.ndarray,
                 alone: bool) -> DataFrame:
    """(word, c, k): the class of every training word. Words that are items have
    their item's. ``alone``: each other word takes by itself the class in which
    all its occurrences are most likely, given the classes of the words before
    and after them; else it has its item's."""
    classes, shared = len(emission), Shared(counts.sparkSession, (items, of))

    def class_of(words: pd.Series) -> pd.Series:
        known, cls = shared.value
        ids = known.of(list(words))
        return pd.Series(np.where(ids < len(known.words), cls[ids], -1) if alone else cls[ids], dtype="int32")

    by_item = counts.select("word", "c", F.pandas_udf(_typed(class_of), "int")("word").alias("k")).where("k >= 0")
    if not alone:
        return by_item

    def best(words: pa.Array, seen: np.ndarray) -> pa.RecordBatch:
        after, before = seen[:, :classes], seen[:, classes:]
        c = before.sum(1)
        likely = after @ moves.T + before @ moves - c[:, None] * emission
        likely[:, 0] = -np.inf  # the end's
        return pa.RecordBatch.from_arrays([words, pa.array(c.astype(np.int64)), pa.array(likely.round(9).argmax(1).astype(np.int32))],
                                          names=["word", "c", "k"])

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by word; the last word of a batch may go on in the next."""
        last, held = None, np.zeros((1, 2 * classes))
        for batch in batches:
            if not (rows := batch.num_rows):
                continue
            words, codes, numbers = batch.columns
            new = np.append(True, pc.not_equal(words.slice(1), words.slice(0, rows - 1)).to_numpy(zero_copy_only=False))
            run = np.cumsum(new) - 1
            cell = np.repeat(run, codes.value_lengths().to_numpy()) * (2 * classes) + codes.flatten().to_numpy()
            seen = np.bincount(cell, numbers.flatten().to_numpy(), (run[-1] + 1) * 2 * classes).reshape(-1, 2 * classes)
            if last is not None and last == words[0].as_py():
                seen[0] += held[0]
            elif last is not None:
                yield best(pa.array([last], pa.binary()), held)
            last, held = words[rows - 1].as_py(), seen[-1:].copy()
            if len(seen) > 1:
                yield best(words.take(pa.array(np.flatnonzero(new)[:-1])), seen[:-1])
        if last is not None:
            yield best(pa.array([last], pa.binary()), held)

    seen = _neighbour_classes(train, items, of, classes).repartition("word").sortWithinPartitions("word")
    return seen.mapInArrow(chosen, "word binary, c bigint, k int").unionByName(by_item)


def class_sizes(words: DataFrame, classes: int) -> np.ndarray:
    """log10 of the tokens, the words and one more, by class."""
    size = np.ones(classes)
    for r in words.groupBy("k").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect():
        size[r["k"]] += r["n"] + r["v"]
    return np.log10(size)


def frequent_words(words: DataFrame, most: int) -> pd.DataFrame:
    """The rows of the most frequent words, at most ``most``."""
    # The lowest count whose words are at most as many, from a histogram of counts in steps of a sixteenth of an octave.
    step = F.floor(F.log2("c") * 16)
    steps = sorted(words.groupBy(step.alias("s")).agg(F.count(F.lit(1)).alias("v")).collect(), key=lambda r: -r["s"])
    least, held = None, 0
    for r in steps:
        held += r["v"]
        if held > most:
            break
        least = r["s"]
    return words.where(step >= least).toPandas() if least is not None else pd.DataFrame({"word": [], "c": [], "k": []})


class Model:
    """What a task that reads texts needs; bounded by HOT_WORDS and the number of items."""

    def __init__(self, items: Items, of: np.ndarray, hot: pd.DataFrame):
        self.items, self.of = items, of
        self.hot = {bytes(w): i for i, w in enumerate(hot["word"])}
        self.classes = np.append(hot["k"].to_numpy(np.int32), np.int32(0))
        self.logs = np.append(np.log10(hot["c"].to_numpy(np.float64) + 1.0), 0.0)

    def read(self, text: bytes | None) -> tuple:
        """n_tokens, hot tokens, their sum of log10(c + 1), the tokens as classes or, below 0, as other words; these
        words, their numbers and the classes they have unless training knows them."""
        tokens = tokens_of(text)
        get = self.hot.get
        at = np.array([get(t, -1) for t in tokens], np.int32)
        codes, other, numbers = self.classes[at], {}, []
        for i in np.flatnonzero(at < 0):
            j = other.setdefault(tokens[i], len(other))
            if j == len(numbers):
                numbers.append(0)
            numbers[j] += 1
            codes[i] = -1 - j
        return (len(tokens), int((at >= 0).sum()), float(self.logs[at].sum()), codes.astype("<i4").tobytes(), list(other), numbers,
                self.of[self.items.of(list(other))].tolist() if other else [])


def _with_classes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The classes of the tokens in their order, ``seq``."""
    for frame in frames:
        seq = []
        for codes, own, found, k in zip(frame["codes"], frame["classes"], frame["found"], frame["k"]):
            codes, own = np.frombuffer(codes, "<i4").copy(), np.array(own, np.int32)
            if found is not None and len(found):
                own[np.asarray(found, np.int64)] = np.asarray(k, np.int32)
            other = codes < 0
            codes[other] = own[-1 - codes[other]]
            seq.append(codes.astype("<i2").tobytes())
        yield frame[["doc_id", "held_out", "n_tokens", "n_known", "logs"]].assign(seq=seq)


def class_bigrams(seqs: DataFrame, classes: int) -> Bigrams:
    """How often each class follows each other over the training texts."""
    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = np.zeros(classes * classes, np.int64)
        for frame in frames:
            for seq in frame["seq"]:
                k = np.frombuffer(seq, "<i2").astype(np.int64)
                table += np.bincount(np.concatenate([[0], k[:-1]]) * classes + k, minlength=len(table))
        cell = np.flatnonzero(table)
        yield pd.DataFrame({"cell": cell, "n": table[cell]})

    sums = (seqs.where(~F.col("held_out")).select("seq").mapInPandas(count, "cell bigint, n bigint")
            .groupBy("cell").agg(F.sum("n").alias("n")).toPandas().sort_values("cell"))
    cell = sums["cell"].to_numpy(np.int64)
    return Bigrams(classes, cell // classes, cell % classes, sums["n"].to_numpy(np.int64))


def score_documents(docs: DataFrame, modulus: int = 7, held: int = 2, core: int = CORE_WORDS, endings: int | None = None,
                    classes: int = CLASSES, hot_words: int = HOT_WORDS) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score and score (log10 probabilities, the end included).

    The model learns from documents whose crc32 of doc_id modulo ``modulus``
    is not ``held``; a null id learns too. Null texts are empty and consist
    of their end. Without training documents every count is 0. Repeated rows
    stay repeated and count as often as they stand. Other columns are not read.
    A number of ``endings`` asks for the model of items: words keep the class of their item.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "class-lm")
    rows = docs.select("doc_id", F.coalesce(crc32_mod("doc_id", modulus) == held, F.lit(False)).alias("held_out"),
                       F.coalesce(utf8("text"), F.lit(b"")).alias("text"))
    train = rows.where(~F.col("held_out"))
    with shuffles_freed(spark):
        counts, _ = scratch.write(word_counts(train))
        total, n_words = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
        items = choose_items(counts, core, endings)
        bigrams = item_bigrams(train, items)
        of = exchange(bigrams, classes)
        k = int(of.max()) + 1
        emission = class_sizes(word_classes(train, counts, items, of, np.zeros((k, k)), np.zeros(k), False), k)
        words, _ = scratch.write(word_classes(train, counts, items, of, transitions(bigrams, of), emission, endings is None))
        if endings is None:
            emission = class_sizes(words, k)
        model = Shared(spark, Model(items, of, frequent_words(words, hot_words)))

        def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                for at in range(0, len(frame), 512):
                    part = frame.iloc[at:at + 512]
                    parts = pd.DataFrame([model.value.read(t) for t in part["text"]],
                                         columns=["n_tokens", "n_hot", "hot_log", "codes", "words", "numbers", "classes"])
                    yield pd.concat([part[["doc_id", "held_out"]].reset_index(drop=True), parts], axis=1)

        coded, at = scratch.write(rows.mapInPandas(
            read, "doc_id bigint, held_out boolean, n_tokens bigint, n_hot bigint, hot_log double, codes binary, "
                  "words array<binary>, numbers array<bigint>, classes array<int>").withColumn("row", F.monotonically_increasing_id()))
        other = coded.select("row", F.posexplode(F.arrays_zip("words", "numbers")).alias("i", "w")).select(
            "row", "i", F.col("w.words").alias("word"), F.col("w.numbers").alias("n"))
        # Words that are not broadcast; inner, as an unknown word adds log10(0 + 1) = 0 and keeps its item's class.
        found = other.join(words, "word").groupBy("row").agg(
            F.sum("n").alias("n_other"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("other_log"),
            F.collect_list("i").alias("found"), F.collect_list("k").alias("k"))
        seqs, _ = scratch.write(coded.drop("words", "numbers").join(found, "row", "left").select(
            "doc_id", "held_out", "n_tokens", (F.col("n_hot") + F.coalesce("n_other", F.lit(0))).alias("n_known"),
            (F.col("hot_log") + F.coalesce("other_log", F.lit(0.0))).alias("logs"), "codes", "classes", "found", "k").mapInPandas(
                _with_classes, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, logs double, seq binary"))
        scratch.drop(at)
        moves = transitions(class_bigrams(seqs, k), np.arange(k))

    def part(seqs: pd.Series) -> pd.Series:
        out = []
        for seq in seqs:
            own = np.frombuffer(seq, "<i2").astype(np.int64)
            out.append(moves[np.concatenate([[0], own[:-1]]), own].sum() - emission[own].sum())
        return pd.Series(out, dtype="float64")

    part.__annotations__ = {"seqs": pd.Series, "return": pd.Series}
    return seqs.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("bigint").alias("train_tokens"),
        (F.col("logs") - F.col("n_tokens") * F.lit(float(np.log10(total + n_words + 1)))).alias("base_score"),
        (F.col("logs") + F.pandas_udf(part, "double")("seq")).alias("score"))
