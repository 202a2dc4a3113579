import random

import numpy as np
import pyarrow as pa
import pytest

from claimsmith.llm import queries
from claimsmith.llm import token_counts as T
from tests.conftest import SF_SMALL

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"]


def plain(texts, name=FILES[0]):
    """Counts of whole texts, one library call each."""
    path = queries.tokenizer_path(name)
    if name.endswith(".model"):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        return [len(model.encode(t or "")) for t in texts]
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    return [len(tok.encode(t or "", add_special_tokens=False).ids) for t in texts]


def test_query_equals_plain_counts(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = queries.op11_token_counts(spark, SF_SMALL)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    want = [(i, len(t.encode()), n, n > 1024) for (i, t), n in zip(docs, plain([t for _, t in docs]))]
    assert sorted(map(tuple, got.collect())) == sorted(want)


ALPHABET = ["a", "b", "Z", "'s", "'ll", " ", " ", "  ", "\n", "\t", " \n", "1", "23", "!", "?!", "É", "ß", "Σ", "漢字", "́",
            "😀", "_", "-", "the", " of", " x", "\x00", "\x1c", "\x1f", "\x85", "\xa0", " ", "٣", "½", "‍", "▁", "<s>", "</w>",
            "<|endoftext|>", "<|startoftext|>", "ing", "e", "İ", "ﬁ"]


@pytest.mark.parametrize("name", FILES)
def test_parts_add_up(name):
    rng = random.Random(name)
    texts = ["".join(rng.choices(ALPHABET, k=rng.randrange(0, 80))) for _ in range(700)]
    texts += ["", " ", "x" * 4000, "漢" * 3000, "ab " * 2000, "a\n" * 500, " a", "a ", "\n\na", "<|endoftext|> a <|endoftext|>"]
    encoder = T.LengthEncoder(queries.tokenizer_path(name))
    assert encoder.place is not None
    want = plain(texts, name)
    for longest in (1, 7, 100, T.SEGMENT_CHARS):
        assert [sum(encoder.counts(list(encoder.segments(t, longest)))) for t in texts] == want
    assert T._lengths(pa.array([None, *texts]), encoder).to_pylist() == [0, *want]


def test_long_texts_go_in_bounded_calls(monkeypatch):
    monkeypatch.setattr(T, "SEGMENT_CHARS", 100)
    monkeypatch.setattr(T, "CALL_BYTES", 1000)
    monkeypatch.setattr(T, "_KNOWN_WORDS", 50)
    encoder = T.LengthEncoder(queries.tokenizer_path())
    held, counts = [], encoder.counts
    encoder.counts = lambda segments: held.append(sum(map(len, segments))) or counts(segments)
    monkeypatch.setattr(T.LengthEncoder.segments, "__defaults__", (100,))
    rng = random.Random(4)
    texts = [" ".join(rng.choices(["alpha", "beta", "gam ma", "é"], k=k)) for k in (0, 1, 5000, 3, 40, 2, 900)]
    assert T._lengths(pa.array(texts), encoder).to_pylist() == plain(texts)
    assert max(held) < 1400 and len(held) > 20


def test_calls_are_of_equal_bytes():
    sizes = np.random.default_rng(3).integers(0, 50, 1000)
    calls = T.balanced_calls(sizes, 1000)
    assert [i for c in calls for i in range(c.start, c.stop)] == list(range(1000))
    per_call = [int(sizes[c].sum()) for c in calls]
    assert max(per_call) <= 1000 + 50 and max(per_call) - min(per_call) <= 100
    assert T.balanced_calls(np.zeros(0, np.int64)) == []
    assert T.balanced_calls(np.zeros(3, np.int64)) == [slice(0, 3)]


def test_unknown_kinds_are_not_cut():
    split = {"type": "Split", "pattern": {"Regex": r"[\p{L}]+|[^\s\p{L}]+"}, "behavior": "Removed", "invert": True}
    assert T._splits_at_white({"pre_tokenizer": split})
    assert not T._splits_at_white({"pre_tokenizer": split | {"behavior": "Isolated"}})
    assert not T._splits_at_white({"pre_tokenizer": split | {"pattern": {"Regex": r"\w+ ?"}}})
    assert not T._splits_at_white({"pre_tokenizer": split, "normalizer": {"type": "Strip"}})
    byte_level = {"type": "ByteLevel", "use_regex": True, "add_prefix_space": False}
    assert T._splits_at_white({"pre_tokenizer": byte_level})
    assert not T._splits_at_white({"pre_tokenizer": byte_level | {"add_prefix_space": True}})
    token = {"content": "<x>", "lstrip": True, "rstrip": False, "single_word": False}
    assert not T._splits_at_white({"pre_tokenizer": byte_level, "added_tokens": [token]})
    assert not T._splits_at_white({})


def test_nulls_repeats_clashing_columns_and_empty(spark):
    df = spark.createDataFrame(
        [(None, "a b", 7, "p"), (3, None, 8, "q"), (3, "c c", 9, None), (3, "c c", 9, None), (1, "", 1, "r")],
        "doc_id long, text string, n_tokens int, token_count string")
    got = T.count_tokens(df, queries.tokenizer_path(), limit=1)
    assert got.columns == ["doc_id", "n_tokens", "token_count"]
    rows = sorted(((r.doc_id or 0, r.n_tokens, *r.token_count) for r in got.collect()))
    assert rows == [(0, 7, 3, 2, True), (1, 1, 0, 0, False), (3, 8, 0, 0, False), (3, 9, 3, 2, True), (3, 9, 3, 2, True)]
    assert T.count_tokens(df.limit(0), queries.tokenizer_path()).count() == 0
