"""Ids of texts with added tokens, and of texts the fast encoder can't take."""

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from folio.llm import packing
from tests.llm.helpers import frame

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|> x", "é <|endoftext|", " <|endoftext|>\n\n  tail"]


@pytest.mark.parametrize("text", [*TEXTS, "x" + " " * 2_000_000 + "y <|endoftext|>"])
def test_ids_are_those_of_default_tokenizers(text):
    want = Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids
    assert packing.load_encoder(PATH)(text).tolist() == want


def test_one_text_of_spaces_does_not_end_the_query(spark):
    rows = [(1, " " * 2_000_000), (2, "plain text"), (3, TEXTS[0])]
    got = packing.pack(frame(spark, rows), PATH).collect()
    tok = Tokenizer.from_file(PATH)
    want = {d: len(tok.encode(t, add_special_tokens=False).ids) + 1 for d, t in rows}
    assert {r.doc_id: r.doc_tokens for r in got} == want
    assert {d: sum(r.length for r in got if r.doc_id == d) for d in want} == want
