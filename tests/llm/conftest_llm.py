import random

import pytest

import public_tokenizers

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


def prose(seed: int, words: int, of: str = "abcdefgh") -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice(of) for _ in range(r.randint(2, 7))) for _ in range(words))


def texts() -> list[str | None]:
    """Every awkward case once: null, empty, white space, very long, unbroken, repeated, foreign, odd bytes."""
    base = prose(1, 120)
    return [
        None, "", " ", "\n\t ", "word", "  two  spaces ", "a\n b\n\nc \n", base, base, base.upper(), prose(2, 9000), "x" * 30_000,
        "ab " * 400, "ab cd " * 300, "日本語のテキスト 🙂 and ﬁ", "null\x00byte and \x1f here\x85now", "▁marker ▁▁ in text", "<|endoftext|> <s> </s>",
        base[:200] + " changed " + base[200:], prose(3, 60) + " " + base, "12345 678", "!!! ... ???", "don't won't 'll x's",
    ]


@pytest.fixture(scope="session")
def messy(spark):
    """The awkward texts with a null id, a repeated row, and columns named like results."""
    rows = [(i, t, "en" if i % 2 else None, 7, -1.5, "mine", None) for i, t in enumerate(texts())]
    rows += [rows[7], (None, "no id", None, 1, 0.0, "x", None), (100, texts()[10], "en", 0, 0.0, "y", None)]
    names = "doc_id long, text string, lang string, n_tokens int, score double, spans string, items array<string>"
    return spark.createDataFrame(rows, names).repartition(3)


@pytest.fixture(scope="session")
def no_rows(messy):
    return messy.where("false")
