"""Plain versions of contracts and shared fixtures for the tests of this folder."""

from __future__ import annotations

import zlib

import public_tokenizers
from tokenizers import Tokenizer

TRICKY = [
    None,
    "",
    " ",
    "\n\n",
    "one",
    "It's  two   spaces \n\n and\tTabs ",
    "tail  ",
    "  head",
    "a \n  b\r\n c\x0b\x0c d\x1e e\x1c\x1df",
    "Straße ÉCOLE e\u0301cole Σίσυφος ΟΔΥΣΣΕΥΣ \u00a0 nbsp\u2003em",
    "<|endoftext|> and <|startoftext|> are special",
    "a<|ENDOFTEXT|>b <|x",
    "日本語 and 한국어 \U0001f600\U0001f600!",
    "x" * 3000,
    "word " * 5000,
]


def documents(spark, texts, start=0):
    """Documents with these texts, keys from ``start`` on, and clashing extra columns."""
    rows = [(start + i, t, "en", "src", len(t or ""), 1, "key") for i, t in enumerate(texts)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, block long, key string"
    )


def ids(name: str, text: str | None) -> list[int]:
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


def crc(values: list[int]) -> int:
    return zlib.crc32(b"".join(v.to_bytes(4, "little") for v in values))
