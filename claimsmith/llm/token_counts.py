"""Token counts of whole texts, without the ids.

An Arrow function gets the text column in batches and returns one length per
row; the ids stay in the library. Inside a task the texts of an Arrow batch
are regrouped into calls of about equal bytes. A long text is cut into
segments first, so that a call's memory does not grow with the longest text.
Segments are cut into words at the same kind of places; each distinct word of
a call goes through the library's batch encoding once, and a bounded table
keeps the counts of short ones. A text's count is the sum over its words.

A text may be cut only where the tokenizer can't join what stands on both
sides, and where the parts by themselves give the same tokens:

* Byte-level tokenizers with the usual pieces, and tokenizers that drop white
  space and split at it: before white space that follows another character. A
  piece never goes on into white space, and the next one starts there.
* Sentence pieces: at a space between two ASCII letters or digits, if no piece
  of the vocabulary holds a word boundary inside and each text gets a leading
  boundary; the space is left out, as the next part's own boundary stands for it.

Any other tokenizer, and a stretch without such a place, gets its text whole.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Longest segment in characters (up to the next safe place), and bytes for one call of the library.
SEGMENT_CHARS = 1 << 16
CALL_BYTES = 1 << 20
TOKEN_LIMIT = 1024
_KNOWN_WORDS, _KNOWN_CHARS = 500_000, 48

# The characters of Unicode's White_Space, which the libraries' patterns mean by it.
_WHITE = " \t-\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_BEFORE_WHITE = re.compile(f"(?<=[^{_WHITE}])(?=[{_WHITE}])")
_LED_WORD = re.compile(f"[{_WHITE}]*[^{_WHITE}]+|[{_WHITE}]+")
_BETWEEN_WORDS = re.compile(r"(?<=[0-9A-Za-z]) (?=[0-9A-Za-z])")


class LengthEncoder:
    """Token counts by a tokenizer file: ``.model`` goes to sentencepiece,
    any other to tokenizers."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.known: dict[str, int] = {}
        (self._sentence_pieces if path.endswith(".model") else self._library)(path)

    def _sentence_pieces(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        inside = any("▁" in model.id_to_piece(i).lstrip("▁") for i in range(model.get_piece_size()))
        led = model.encode("a", out_type=str)[0].startswith("▁")
        self.place = _BETWEEN_WORDS if led and not inside else None
        self.words = self.place.split if self.place else None
        self.lengths = lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]

    def _library(self, path: str) -> None:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        self.place = _BEFORE_WHITE if _splits_at_white(json.loads(tokenizer.to_str())) else None
        self.words = _LED_WORD.findall if self.place else None
        self.lengths = lambda texts: [len(e) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def segments(self, text: str, longest: int = SEGMENT_CHARS) -> Iterator[str]:
        """The text in segments whose token counts add up to its own."""
        start = 0
        while self.place and len(text) - start > longest:
            found = self.place.search(text, start + longest)
            if found is None:
                break
            yield text[start:found.start()]
            start = found.end()
        yield text[start:]

    def counts(self, segments: list[str]) -> list[int]:
        """Tokens of each segment; every distinct new word is encoded once."""
        if not self.words:
            return self.lengths(segments)
        split, known = [self.words(s) for s in segments], self.known
        if len(known) > _KNOWN_WORDS:
            known.clear()
        new = list(set().union(*split).difference(known))
        known.update(zip(new, self.lengths(new)))
        out = [sum(map(known.__getitem__, words)) for words in split]
        for word in new:
            if len(word) > _KNOWN_CHARS:
                del known[word]
        return out


def _splits_at_white(spec: dict) -> bool:
    """Whether a tokenizers file can be cut before white space."""
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"]) for t in spec.get("added_tokens") or []):
        return False
    split, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer") or {}
    if split.get("type") == "ByteLevel":
        return bool(split.get("use_regex") and not split.get("add_prefix_space") and not norm)
    first, *rest = split.get("pretokenizers") or [split]
    norms = norm.get("normalizers") or ([norm] if norm else [])
    spaces = {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}
    if not all(n == spaces or n["type"] in ("NFC", "NFD", "Lowercase") for n in norms):
        return False
    if not all(s.get("type") == "ByteLevel" and not s.get("add_prefix_space") and not s.get("use_regex") for s in rest):
        return False
    # What the pattern keeps must hold no white space: but for negated classes with \s, nothing in it can match any.
    pattern = re.sub(r"\[\^\\s[^]]*\]", "", (first.get("pattern") or {}).get("Regex", " "))
    return first.get("type") == "Split" and first.get("behavior") == "Removed" and bool(first.get("invert")) and not re.search(
        r"\\[sSWDPXv]|[. ]|\[\^", pattern)


def balanced_calls(sizes: np.ndarray, most: int = CALL_BYTES) -> list[slice]:
    """Consecutive slices of about equal bytes, as many as ``most`` bytes a call ask for."""
    total = int(sizes.sum())
    calls = max(1, -(-total // most))
    call = (np.cumsum(sizes) - sizes) * calls // max(total, 1)
    ends = [*(np.flatnonzero(np.diff(call)) + 1).tolist(), len(sizes)]
    return [slice(a, b) for a, b in zip([0, *ends], ends) if a < b]


def _lengths(texts: pa.Array, encoder: LengthEncoder) -> pa.Array:
    """Token counts of one Arrow batch; nulls count as empty texts."""
    counts = np.zeros(len(texts), np.int64)
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    for call in balanced_calls(sizes):
        rows: list[int] = []
        segments: list[str] = []
        held = 0
        for row in (call.start + np.flatnonzero(sizes[call])).tolist():
            for segment in encoder.segments(texts[row].as_py()):
                rows.append(row)
                segments.append(segment)
                held += len(segment)
                if held >= CALL_BYTES:  # a long text gets calls of its own
                    np.add.at(counts, rows, encoder.counts(segments))
                    rows, segments, held = [], [], 0
        if segments:
            np.add.at(counts, rows, encoder.counts(segments))
    return pa.array(counts)


def n_tokens(text: str | Column, tokenizer: str) -> Column:
    """Number of tokens of a text as an Arrow function of the column.

    ``tokenizer``: path of a file, the same on every executor. No begin, end
    or added special tokens; strings of special tokens inside a text are
    handled as by the library's default; nothing is truncated or padded.
    """
    @F.arrow_udf("bigint")
    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = LengthEncoder(tokenizer)
        for texts in batches:
            yield _lengths(texts, encoder)

    return counted(text)


def count_tokens(docs: DataFrame, tokenizer: str, text_col: str = "text", out: str = "token_count",
                 limit: int = TOKEN_LIMIT) -> DataFrame:
    """The documents without their text, with ``out``: a struct of n_bytes
    (UTF-8), n_tokens and over_limit (more than ``limit`` tokens).

    Null and empty texts have no bytes and no tokens. Repeated rows, null ids
    and further columns stay as they are; an input column named as ``out`` is
    replaced. An empty table gives no rows.
    """
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in (text_col, out)]
    text = F.col(f"`{text_col}`")
    sized = docs.select(F.struct(F.lit(0).alias("_"), *rest).alias("doc"),
                        F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("n_bytes"),
                        n_tokens(text, tokenizer).alias("n_tokens"))
    counted = sized.withColumn("made", F.struct("n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")))
    return counted.select("doc.*", "made").drop("_").withColumnRenamed("made", out)
