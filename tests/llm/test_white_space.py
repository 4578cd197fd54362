"""Ids of texts that begin and end in white space, in any company and order, against the library's."""

import random

import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tracewell.llm import bpe_trie, queries, rans_files
from tracewell.llm.common import table

BYTE_BPE, WORD_BPE = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
PIECES = [" ", "  ", "\n", "\t", "\x0b", "\x85", "\xa0", "　", "a", "b", "Zq", "é", "ж", "1", " x", "!", "'s", "<|endoftext|>"]


@pytest.mark.parametrize("pieces", [[" ", "\n", "\t", "a", "bc"], PIECES])
def test_slices_of_white_space(pieces):
    """10,000 texts, in slices of one to hundreds of them: a text's ids don't depend on the others of its slice."""
    library, ours, chance = Tokenizer.from_file(BYTE_BPE), rans_files.Tokens(BYTE_BPE), random.Random(len(pieces))
    for size in [1] * 300 + [2] * 600 + [7] * 300 + [50] * 50 + [400] * 10:
        texts = ["".join(chance.choices(pieces, k=chance.randint(0, 9))) for _ in range(size)]
        assert [x.tolist() for x in ours.encode(pa.array(texts))] == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]


PAIRS = [["one two\n", "\n\nthree four"], ["a b  ", "\tc  d"], ["a b\n", "\nc"], [" x ", " x "], ["\n", "\n\n", "", "a\n"]]


@pytest.mark.parametrize("texts", [PAIRS[0], PAIRS[0][::-1], PAIRS[1] + PAIRS[2], PAIRS[4]])
def test_registered_queries(spark, tmp_path, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    library = Tokenizer.from_file(BYTE_BPE)
    ids = [library.encode(t, add_special_tokens=False).ids for t in texts]
    got = sorted((r.doc_id, r.start, r.n_tokens) for r in queries.op5_rans_files(spark, str(tmp_path)).collect())
    assert got == [(i, sum(len(x) + 1 for x in ids[:i]), len(x) + 1) for i, x in enumerate(ids)]
    words = Tokenizer.from_file(WORD_BPE)
    words.no_truncation(), words.no_padding()
    coded = bpe_trie.decode(bpe_trie.encode(table(spark, str(tmp_path), "documents"), WORD_BPE), WORD_BPE)
    for r in coded.collect():
        wanted = words.encode(r.text, add_special_tokens=False).ids
        assert (r.token_ids, r.decoded) == (wanted, words.decode(wanted, skip_special_tokens=False))


def test_known_chunks_are_not_encoded_again():
    """A chunk that a worker knows goes to no tokenizer again; forgetting some changes no ids."""
    library = Tokenizer.from_file(BYTE_BPE)
    for limit in (1_000_000, 3, 0):
        ours, asked = rans_files.Tokens(BYTE_BPE), []
        ours.met.limit = limit
        encode = ours.chunks
        ours.chunks = lambda chunks: asked.extend(chunks) or encode(chunks)  # noqa: B023
        for text in ("one two, three two, four", "nought three two, five 中文 éé", "a two, six 中文", "b one two, 中文"):
            assert ours.encode(pa.array([text]))[0].tolist() == library.encode(text, add_special_tokens=False).ids
        if limit > 3:
            assert len(asked) == len(set(asked))
