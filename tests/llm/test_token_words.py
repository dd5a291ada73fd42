"""Words of token files: put together of runs, learned by the model alone, and kept while they are met again."""

import random

import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from pitlens.llm import tokenfiles

PARTS = ["alpha", "Ünïcode", "ç", "A", "ɏ", "ñandú", "###", ".", ",", "<|", "|>", "endoftext", "<|endoftext|>", "'", "'s", "\n", "\n\n", "\t", "7", "42", "中文", "́", " ", "\x85", "ß", "_", "`", "€", "ǅ", "ֿ", "\r\n"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenfiles.TOKENIZER)


@pytest.mark.parametrize("memo", [60, 10_000])
def test_words_of_runs_equal_the_library(library, memo):
    draw = random.Random(memo)
    made = tokenfiles.Encoder(tokenfiles.TOKENIZER, memo=memo)
    for _ in range(30):
        texts = [" ".join("".join(draw.choice(PARTS) for _ in range(draw.randrange(0, 6))) for _ in range(draw.randrange(0, 9))) for _ in range(60)] + ["é" * 1500 + "#a b", "a\n", "\na", "a \nb"]
        got = made.batch(pa.array(texts))
        assert [g.tolist() for g in got] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_few_words_need_the_whole_tokenizer():
    """Letters go to the model, words with signs and line ends are their runs; both were encoded word by word before, in over 400 CPU seconds a GB."""
    made, seen = tokenfiles.Encoder(tokenfiles.TOKENIZER), []

    class Counting:
        def encode_batch_fast(self, texts, **kw):
            seen.extend(texts[0].split(made.between[0]))
            return real.encode_batch_fast(texts, **kw)

    real, made.tokenizer = made.tokenizer, Counting()
    made.batch(pa.array(["x " + " ".join(f"w{a}{b}.\nÉt{b}{a}###" for a in "abcdefgh" for b in "klmnopqr")]))
    assert set(seen) <= {"\n", "###", "."}


def test_a_full_memory_keeps_words_met_again():
    made = tokenfiles.Encoder(tokenfiles.TOKENIZER, memo=40)
    for i in range(8):
        made.batch(pa.array(["x again always " + " ".join("new" + chr(97 + i) + chr(97 + j) for j in range(12))]))
    assert {"again", "always"} <= made.words.keys() and made.count <= 60 and "newaa" not in made.words
    learned = []
    made._learn = lambda words, heads, learn=made._learn: (learned.extend(words), learn(words, heads))
    made.batch(pa.array(["x " + " ".join("late" + chr(97 + j) * k for j in range(12) for k in (1, 2, 3)) + " again"]))
    made.batch(pa.array(["x again"]))
    assert "again" not in learned
