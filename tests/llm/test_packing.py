import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from fixtures import DOCS, SF, awkward, nothing
from tokenizers import Tokenizer

from shardweave.llm import packing
from shardweave.llm.queries import QUERIES, TOKENIZER


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


def check_pieces(pieces, expected):
    """``expected``: doc_id -> list of the ids of its rows."""
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_sequence[p.sequence_id].append((p.offset, p.length))
        by_doc[p.doc_id].append(p)
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= 1024
    for key, rows in expected.items():
        found = sorted((p.start, bytes(p.ids)) for p in by_doc[key])
        whole = sorted(b"".join(np.array(ids, dtype="<u4").tobytes() for ids in rows))
        assert sorted(b"".join(b for _, b in found)) == whole
        if len(rows) == 1:
            assert b"".join(b for _, b in found) == np.array(rows[0], dtype="<u4").tobytes()
            assert sum(p.length for p in by_doc[key]) == by_doc[key][0].doc_tokens == len(rows[0])
    return by_sequence


def test_awkward_documents(spark, tokenizer):
    docs = awkward(spark)
    expected = defaultdict(list)
    for r in docs.collect():
        expected[r.doc_id].append([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0])
    check_pieces(packing.pack_documents(docs, TOKENIZER).collect(), expected)


def test_special_strings_and_odd_characters_are_text(tokenizer):
    encoder = packing.byte_bpe(TOKENIZER)
    for text in ("<|endoftext|> a", "\x00\x01 ​漢字🙂 ﬁ", "  a\n\n b\t", "x" * 3000, "don't we'll I'm"):
        assert encoder.encode_ordinary(text) == tokenizer.encode(text, add_special_tokens=False).ids


def test_added_tokens_are_as_in_an_unchanged_tokenizer(spark):
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["<|endoftext|> a", "a <|endoftext|><|endoftext|>b\n", "<|endoftext| >", "don't  <|endoftext|>", "\x00 漢字🙂", ""]
    expected = {i: [[*plain.encode(t, add_special_tokens=False).ids, 0]] for i, t in enumerate(texts)}
    assert expected[0][0][:2] == [50256, 257]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCS)
    check_pieces(packing.pack_documents(docs, TOKENIZER).collect(), expected)


@pytest.mark.parametrize("space", [" ", "\n", "\t", "\u3000", " \n"])
def test_long_white_space_is_as_in_tokenizers(space):
    plain, encoder = Tokenizer.from_file(TOKENIZER), packing.byte_bpe(TOKENIZER)
    run = space * (1_200_000 // len(space))
    short = space * (60_000 // len(space))
    for text in (run, f"word{run}next", f"a{short}'s {short}<|endoftext|>{short}<|endoftext|> b{short}", f"{short}\x1c{short}x", f"{short}\n1"):
        assert packing.encode(encoder, text) == plain.encode(text, add_special_tokens=False).ids


def test_ten_million_spaces_in_a_document(spark):
    plain = Tokenizer.from_file(TOKENIZER)
    texts = ["a" + " " * 10_000_000 + "b", "\n" * 10_000_000]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCS)
    expected = {i: [[*plain.encode(t, add_special_tokens=False).ids, 0]] for i, t in enumerate(texts)}
    check_pieces(packing.pack_documents(docs, TOKENIZER).collect(), expected)


def test_empty_table(spark):
    assert packing.pack_documents(nothing(spark, DOCS), TOKENIZER).collect() == []


def test_query_covers_every_id_and_pads_little(spark, tokenizer):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op2_packing"](spark, SF).collect()
    whole = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for i, t in docs.items()}
    for r in rows:
        ids = whole[r.doc_id]
        piece = np.array(ids[r.start : r.start + r.length], dtype="<u4")
        assert (r.ids_crc32, r.doc_tokens) == (zlib.crc32(piece.tobytes()), len(ids))
    total = sum(r.length for r in rows)
    assert total == sum({r.doc_id: r.doc_tokens for r in rows}.values())
    sequences = len({r.sequence_id for r in rows})
    assert sequences * 1024 - total < 1024 * 10


@pytest.mark.parametrize("cut", [True, False])
def test_all_three_limits_hold(spark, cut):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(600):
        n = int(rng.integers(1, 60))
        rows.append((i, list(range(n)), rng.integers(0, 2, n).tolist()))
    df = spark.createDataFrame(rows, "id long, ids array<int>, mask array<int>").coalesce(1)
    limits = packing.Limits(tokens=64, segments=4, loss_tokens=30 if cut else 60)
    found = packing.pack_examples(df, "id", "ids", "mask", limits, cut=cut, min_piece=2).collect()
    used = defaultdict(lambda: np.zeros(3, dtype=int))
    ids = defaultdict(list)
    for p in found:
        used[p.sequence_id] += (p.length, 1, p.loss_tokens)
        ids[p.doc_id].append((p.start, list(np.frombuffer(p.ids, "<u4"))))
    assert (np.array(list(used.values())) <= (64, 4, limits.loss_tokens)).all()
    for i, whole, _ in rows:
        assert [x for _, part in sorted(ids[i]) for x in part] == whole
        assert cut or len(ids[i]) == 1
    # never more than half again of what the limits make unavoidable
    least = max(np.array(list(used.values())).sum(axis=0) / (64, 4, limits.loss_tokens))
    assert len(used) <= 1.5 * least + 1


def test_what_cannot_fit_is_an_error(spark):
    df = spark.createDataFrame([(1, list(range(70)))], "id long, ids array<int>")
    with pytest.raises(Exception, match="does not fit"):
        packing.pack_examples(df, "id", "ids", limits=packing.Limits(tokens=64)).collect()
