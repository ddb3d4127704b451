"""Ids made word by word equal the tokenizer's ids of the whole text."""

import random

import numpy as np
import pytest

from hearth.llm import packing
from hearth.llm.queries import tokenizer_path

LETTERS = "".join(map(chr, range(0xA0, 0x180))) + "abcXYZ"
KINDS = {"letters": LETTERS, "mixed": LETTERS + "019 '.-\"\t", "marks": LETTERS + "̧́ſKİ "}


@pytest.mark.parametrize("kind", sorted(KINDS))
def test_words_with_other_letters(kind):
    from tokenizers import Tokenizer
    path = tokenizer_path()
    whole, by_word, rng = Tokenizer.from_file(path), packing.encoder(path), random.Random(kind)
    texts = ["".join(rng.choice(KINDS[kind]) for _ in range(rng.randint(0, 60))) for _ in range(2000)]
    for text in [*texts, "it's l'ÉTÉ d'Ÿ naïve Straße ÆØÅ ÷×"]:
        assert by_word(text) == np.array(whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text
