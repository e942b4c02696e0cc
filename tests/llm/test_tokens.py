import random

import pandas as pd
import pyarrow as pa
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from noticeflow.llm.tokens import PieceEncoder, encoder

CASES = [("byte_bpe_50k.json", "spaced"), ("word_bpe_49k.json", "words")]
ODD = [
    "", " ", "\n", "  a", "a  ", "a\n\n b", "\ta\x1cb", "!\x1c!", "a\xa0b", "a \xa0 b", "\xa0", "a　 b",
    "it's we'll 'S 12 3a", "<|endoftext|> x <|startoftext|>", "é ñ ́x", "ΑΣ Σ İı ß", "日本 語",
    "a\r\nb\x0bc\x0cd", "👍🏽 ok", "​z", "x y", "x   y", "a\x85b", "a \x85 b", "a \n b",
]


@pytest.mark.parametrize("file,cut", CASES)
def test_equal_to_the_whole_text(file, cut):
    """Pieces give the ids that the library gives for the whole text."""
    texts = list(ODD) + list(pd.read_parquet("/root/testdata/sf0.001/documents.parquet").text[:120])
    rng = random.Random(7)
    alphabet = ["a", "B", "é", "'s", " ", "  ", "\n", "\t", "\xa0", "́", "7", "!", "\x1c", "\u200b", "\u3000", "\ufeff", "ß", " ", "\x85"]
    texts += ["".join(rng.choices(alphabet, k=rng.randint(1, 30))) for _ in range(3000)]
    whole = Tokenizer.from_file(P.path(file))
    whole.encode_special_tokens = True
    mine = PieceEncoder(P.path(file), cut, remembered=500)
    for at in range(0, len(texts), 97):
        part = texts[at : at + 97]
        ids, lengths = mine.encode(pa.array(part))
        want = [whole.encode(t, add_special_tokens=False).ids for t in part]
        assert lengths.tolist() == [len(w) for w in want]
        assert ids.tolist() == [i for w in want for i in w]


LITERALS = [
    "a <|endoftext|> b <|startoftext|>", "<|endoftext|>", "x<|endoftext|>y", "Ends.<|endoftext|>\n Next, one",
    "<|endoftext|><|endoftext|> ", " <|startoftext|>\n\n<|endoftext|>\xa0z", "<|EndOfText|> <|endoftext |>",
    "<<|endoftext|>>'s", "\0 a <|endoftext|> b", "plain", "", "<|endoftext|", "é<|startoftext|>́x",
]


@pytest.mark.parametrize("file,cut", CASES)
def test_literals_of_special_tokens(file, cut):
    """What the operators use gives the ids of the library's default, with other texts between."""
    rng = random.Random(9)
    alphabet = ["<|endoftext|>", "<|startoftext|>", "<|", "|>", "a", "B.", " ", "\n", "\xa0", "́", "7", "\0"]
    texts = LITERALS + ["".join(rng.choices(alphabet, k=rng.randint(1, 12))) for _ in range(2000)]
    whole, mine = Tokenizer.from_file(P.path(file)), encoder(P.path(file), cut)
    for part in (texts, [None, *LITERALS[9:11]], []):
        ids, lengths = mine.encode(pa.array(part, pa.string()))
        want = [whole.encode(t or "", add_special_tokens=False).ids for t in part]
        assert lengths.tolist() == [len(w) for w in want]
        assert ids.tolist() == [i for w in want for i in w]
