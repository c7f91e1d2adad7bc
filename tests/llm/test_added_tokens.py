"""Token ids of texts that spell an added token, against the library's plain call."""

from __future__ import annotations

import random

import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tallywork.llm import arrow_shards, tokens

FILES = {name: public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "word_bpe_49k.json")}


@pytest.mark.parametrize("name", FILES)
def test_ids_are_those_of_the_plain_call(name):
    dice = random.Random(6)
    signs = ["a", "B c", "É", "'s", " ", "\n", "1.", "<|", "|>", "<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>", "endoftext", "İ"]
    texts = ["".join(dice.choice(signs) for _ in range(dice.randrange(1, 20))) for _ in range(3000)] + ["", "x <|endoftext|> y " * 300, "plain Text"]
    tokenizer = Tokenizer.from_file(FILES[name])
    found = dict(tokens.documents_ids(pa.array(texts, pa.large_string()), FILES[name], 2, added=True))
    for row, own in enumerate(tokenizer.encode_batch(texts, add_special_tokens=False)):
        assert found[row].tolist() == [*own.ids, 2], repr(texts[row])


def test_shards_have_the_ids_of_the_plain_call(spark, tmp_path):
    texts = ["before <|endoftext|> after", "another text"]
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    path = FILES["byte_bpe_50k.json"]
    rows = arrow_shards.read_documents(arrow_shards.write_shards(documents, f"file://{tmp_path}/shards", path)).orderBy("doc_id").collect()
    plain = [len(own.ids) + 1 for own in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert [row["n_tokens"] for row in rows] == plain
