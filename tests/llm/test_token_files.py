import random
import zlib

import numpy as np
import pytest

from claimsmith.llm import queries
from claimsmith.llm import token_files as T
from tests.conftest import SF_SMALL


def plain(texts):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(queries.tokenizer_path())
    return [tok.encode(t or "", add_special_tokens=False).ids + [0] for t in texts]


def digest(docs):
    at, out = 0, []
    for (name, _), ids in zip(docs, plain([t for _, t in docs])):
        out.append((name, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_query_equals_plain_encoding(spark):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect())
    got = queries.op9_token_id_files(spark, SF_SMALL).collect()
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got) == digest(docs)


@pytest.mark.parametrize("planes", [4, 32])
@pytest.mark.parametrize("n", [0, 1, 7, 8, 63, 1000, 4096, 5001])
def test_planes_round_trip(planes, n):
    ids = np.random.default_rng(n).integers(0, 2**32, n, np.uint32)
    payload, sizes = T.pack_ids(ids, planes, block_ids=1024)
    assert len(sizes) == planes * -(-n // 1024)
    assert (T.unpack_ids(payload, sizes, n, planes, block_ids=1024) == ids).all()


def test_pieces_equal_the_library():
    rng = random.Random(1)
    alphabet = ["a", "b", "'s", "'ll", " ", "  ", "\n", "\t", " ", "1", "23", "!", "?!", "É", "ß", "漢字", "́", "😀", "_", "-",
                "the", " of", "\x00", "\x85", "٣", "½", "‍", "<|endoftext|>", "ing"]
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(0, 60))) for _ in range(800)] + ["x" * 5000, "", " "]
    encoder = T.Encoder(queries.tokenizer_path())
    for _ in range(2):
        assert [np.frombuffer(b, "<u4").tolist() + [0] for b in encoder.encode(texts)] == plain(texts)


@pytest.mark.parametrize("planes", [4, 32])
def test_files_over_many_shards(spark, tmp_path, monkeypatch, planes):
    rng = random.Random(planes)
    docs = [(i, rng.choice([None, "", "one two three", "é " * rng.randrange(50), "word" * 400])) for i in range(300)]
    rng.shuffle(docs)
    df = spark.createDataFrame([(*d, "x", 2) for d in docs], "doc_id long, text string, shard string, n_tokens int")
    path = str(tmp_path / "files")
    T.write_token_files(df.repartition(5), path, queries.tokenizer_path(), planes=planes, shard_bytes=1000)
    assert spark.read.parquet(path).select("shard").distinct().count() > 1
    got = T.read_token_index(spark, path).collect()
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got) == digest(sorted(docs, key=lambda d: d[0]))
    ids = {r.doc_id: r.ids for r in T.read_ids(spark, path).collect()}
    ordered = sorted(docs, key=lambda d: d[0])
    assert [ids[i] for i, _ in ordered] == plain([t for _, t in ordered])


def test_null_ids_repeats_and_empty(spark, tmp_path):
    df = spark.createDataFrame([(None, "a b"), (3, "c"), (3, "c"), (1, None)], "doc_id long, text string")
    got = T.encode_and_index(df, queries.tokenizer_path()).collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.start) for r in got) == [(False, 0, 0), (True, 1, 3), (True, 3, 4), (True, 3, 6)]
    assert T.encode_and_index(df.limit(0), queries.tokenizer_path()).count() == 0
    with pytest.raises(ValueError):
        T.write_token_files(df, str(tmp_path / "x"), queries.tokenizer_path(), planes=5)


def test_encoder_keeps_a_bounded_number_of_pieces():
    import public_tokenizers
    from claimsmith.llm.token_files import Encoder

    encoder = Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    words = [f" {''.join(chr(97 + i // 26 ** k % 26) for k in range(4))}" for i in range(400_000)]
    texts = ["".join(words[a:a + 10_000]) + " the same words" for a in range(0, 400_000, 10_000)]
    ids = [encoder.encode([t])[0] for t in texts]
    assert len(encoder.known) + len(getattr(encoder, "old", ())) <= 320_000 < len({p for t in texts for p in encoder.pieces(t)})
    want = encoder.tokenizer.encode_batch_fast(texts[::13], add_special_tokens=False)
    assert [list(memoryview(i).cast("I")) for i in ids[::13]] == [e.ids for e in want]
