"""The memo of words gives the ids of the library itself."""

from __future__ import annotations

import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from wardscope.llm.catalog import BYTE_BPE, WORD_BPE, tokenizer
from wardscope.llm.encoding import Encoder

ODD = [None, "", " ", "\n", "a  b", "a \n b", " lead", "trail ", "\n\nx", "tab\tx y", "nbsp  x", "é ́x ok İstanbul foo.",
       "<|endoftext|> a", "a<|endoftext|>b c", "hello <|endoftext|> there", "<|startoftext|>x <|endoftext|>", "<|endof text|>", "<|ENDOFTEXT|>.", "<|endoftext|>" * 3, "it's we'll 12 3.5 o'clock", "日本語 テキスト。", "a\x1cb c", "क़ क़.", "ſ K ß ΑΣ. ΟΔΟΣ", "ab,\ncd.\n\nef", "w " * 50, "😀 😀a"]


@pytest.mark.parametrize("name", [BYTE_BPE, WORD_BPE])
@pytest.mark.parametrize("limit", [5, 400_000])
def test_equal_ids(name, limit):
    draw = random.Random(3)
    texts = ODD + ["".join(draw.choice(" \n\tab.,'sé1İ́  ") for _ in range(draw.randint(0, 40))) for _ in range(2000)]
    plain = Tokenizer.from_file(tokenizer(name))
    encode = Encoder(tokenizer(name), limit).encode
    for k in range(0, len(texts), 100):
        for text, ids in zip(texts[k:k + 100], encode(texts[k:k + 100])):
            assert ids.dtype == np.dtype("<u4") and ids.tolist() == plain.encode(text or "", add_special_tokens=False).ids, text
