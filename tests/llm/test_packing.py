import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from rxvigil.llm import packing, queries
from tests.llm.samples import awkward, awkward_rng, frame, rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def bpe():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def encode():
    return packing.encoder(queries.byte_bpe())


def expected(bpe, given):
    return sorted(tuple([*bpe(t), 0]) for _, t in given)


def unpacked(found):
    """The ids of each document, put together from its pieces in order."""
    done, at = [], {}
    for r in sorted(found, key=lambda r: r["sequence_id"]):
        if r["start"] == 0:
            at[r["doc_id"]] = []
            done.append(at[r["doc_id"]])
        assert r["start"] == len(at[r["doc_id"]]) and r["offset"] == 0
        ids = np.frombuffer(r["tokens"], "<u4").tolist()
        assert len(ids) == r["length"] == r["bucket"] and r["length"] & (r["length"] - 1) == 0 and r["length"] <= 1024
        at[r["doc_id"]] += ids
    assert len({r["sequence_id"] for r in found}) == len(found)
    return sorted(map(tuple, done))


def test_round_trip_of_awkward_rows(spark, bpe):
    given = awkward(awkward_rng()) + [(20, "<|endoftext|> it's  'll x  y"), (21, " lead"), (22, "trail "), (23, "a\n b")]
    found = rows(packing.pack(frame(spark, given), queries.byte_bpe()))
    assert unpacked(found) == expected(bpe, given)


def test_the_query_on_the_whole_table(spark, bpe):
    found = rows(queries.op3_packing(spark, SF))
    given = {r.doc_id: [*bpe(r.text), 0] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    seen = dict.fromkeys(given, 0)
    for r in found:
        ids = given[r["doc_id"]]
        piece = ids[r["start"] : r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(np.array(piece, "<u4").tobytes()) and r["doc_tokens"] == len(ids)
        seen[r["doc_id"]] += r["length"]
    assert all(seen[i] == len(ids) for i, ids in given.items())


@settings(max_examples=150, deadline=None)
@given(text=st.text(alphabet="ab' \n\t é漢1!", max_size=40))
def test_chunked_ids_equal_the_tokenizer(bpe, encode, text):
    assert np.frombuffer(encode(text), "<u4").tolist() == bpe(text)


def test_empty_table_and_bad_length(spark):
    assert rows(packing.pack(frame(spark, []), queries.byte_bpe())) == []
    with pytest.raises(ValueError):
        packing.pack(frame(spark, []), queries.byte_bpe(), longest=1000)


def test_buckets_on_disk(spark, tmp_path):
    pieces = packing.pack(frame(spark, [(1, "one two three four five")]), queries.byte_bpe())
    packing.write_buckets(pieces, str(tmp_path / "out"))
    lengths = {p.name for p in (tmp_path / "out").iterdir() if p.is_dir()}
    assert lengths == {f"bucket={r['length']}" for r in rows(pieces)}


def plain_call():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def both():
    return packing.encoder(queries.byte_bpe(), queries.added_tokens()), plain_call()


@settings(max_examples=150, deadline=None)
@given(parts=st.lists(st.sampled_from(["<|endoftext|>", "<|endof", "text|>", " ", "  ", "\n", "a", " b's", "漢"]), max_size=12))
def test_added_tokens_equal_the_tokenizers_plain_call(both, parts):
    encode, call = both
    text = "".join(parts)
    assert np.frombuffer(encode(text), "<u4").tolist() == call(text)


@pytest.mark.parametrize("stage", ["op3_packing", "pipeline"])
def test_queries_give_added_tokens(spark, tmp_path, stage):
    import corpus_pipeline

    given = [(1, "one doc<|endoftext|>next doc"), (2, "<|endoftext|> it's")]
    docs = frame(spark, given)
    if stage == "pipeline":
        found = rows(corpus_pipeline.pack_sequences(spark, docs, ""))
        assert unpacked(found) == expected(plain_call(), given)
        return
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    lengths = {r["doc_id"]: r["doc_tokens"] for r in rows(queries.op3_packing(spark, str(tmp_path)))}
    assert lengths == {i: len(plain_call()(t)) + 1 for i, t in given}
