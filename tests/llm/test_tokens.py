"""Ids of texts cut into pieces against the tokenizers library on whole texts."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from cardmill.llm import tokenfile, tokens

PARTS = ["a", "Z", "é", "É", "ß", "µ", "İ", "Σ", "ς", " ", "  ", "\n", "\t", "\x00", "\x1c", "\x85", "\xa0", " ", "'s", "'", "9", "²"]
PARTS += ["é", "ﬁ", "<|endoftext|>", "<|startoftext|>", "!", "--", "日本", "😀", "×", "the", " Of", "&&&", "\r\n", "ẞ", "Ⅷ", "‍", "ª"]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_are_those_of_whole_texts(name):
    chance = random.Random(1)
    texts = ["", *("".join(chance.choices(PARTS, k=chance.randint(0, 14))) for _ in range(3000))]
    own = tokens.Encoder(public_tokenizers.path(name), 500)  # memory fills up on the way
    want = [np.array(own.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert [ids for at in range(0, len(texts), 100) for ids in own.batch(texts[at : at + 100])] == want
    assert own.batch([]) == []


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_plain_words_skip_the_rules(name):
    own, text = tokens.Encoder(public_tokenizers.path(name)), "The Éclair, a word (not) here.\nAnd Üben &&& more###"
    want = np.array(own.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    ruled, library = [], own.tokenizer

    class Counting:
        def encode_batch_fast(self, pieces, **options):
            ruled.extend(pieces)
            return library.encode_batch_fast(pieces, **options)

    own.tokenizer = Counting()
    assert own.batch([text]) == [want] and {p.strip() for p in ruled} <= {"(not)", "&&&", ""}


def test_small_batches_are_encoded_together():
    batches = [pa.RecordBatch.from_arrays([pa.array(["a" * 1000] * n, pa.string())], ["text"]) for n in (3, 0, 4, 9, 2)]
    got = list(tokenfile.joined(iter(batches), 6500))
    assert [b.num_rows for b in got] == [7, 9, 2] and list(tokenfile.joined(iter([]))) == []


def test_packed_ids_come_back():
    for ids in ([], [2], [1, 65535, 2], [65536, 0, 2], [7, 2**32 - 1]):
        ids = np.array(ids, "<u4")
        assert (tokenfile.inflate(tokenfile.deflate(ids), len(ids)) == ids).all()
