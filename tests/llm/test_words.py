"""Ids of words looked up one by one are those of whole texts."""

import random

import numpy as np
import pyarrow as pa
import pytest

from pulse.llm import packing
from pulse.llm.queries import vocabulary

ODD = ["İstanbul", "İ", "ı", "ŉa", "ÉTÉ.", "café,", "café,", "ΣΣ,", "straße!", "×", "a÷b", "×.", "naïve;", "x.", ".x", "..", "!?",
       "don't", "it's,", "<|endoftext|>", "a<|startoftext|>b", "<|ENDOFTEXT|>", "12,5", "w2.", "A1!", "日本語.", "\U0001f600", "\U0001f600.", " ", "a b", "́a", "‍", "eµ", "ª", "ſ", "ƀx", "&&&", "***,", "'s", "'S.", "À'll"]


def texts(seed, n):
    rng = random.Random(seed)
    letters = "abcxyzABCXYZéÉüßŁųñ"
    word = lambda: rng.choice(ODD) if rng.random() < 0.3 else "".join(rng.choice(letters) for _ in range(rng.randrange(1, 9))) + rng.choice(["", "", ".", ",", "!", "?!", "-"])
    return [None, "", " \n ", *(rng.choice(["", " "]) + "".join(word() + rng.choice([" ", "\n", "  ", "\t"]) for _ in range(rng.randrange(40))) for _ in range(n))]


@pytest.mark.parametrize("file", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_of_words_are_those_of_the_text(file, monkeypatch):
    import public_tokenizers

    path = public_tokenizers.path(file)
    known = packing.Words(path)
    assert known.apart == known.simple == (file == "word_bpe_49k.json")
    monkeypatch.setattr(packing, "KNOWN_IDS", 900)  # forgets between batches
    for seed in range(6):
        batch = texts(seed, 60)
        flat, cuts = known.encode(pa.array(batch, pa.string()))
        for text, a, b in zip(batch, cuts[:-1], cuts[1:]):
            assert flat[a:b].tolist() == known.whole.encode(text or "", add_special_tokens=False).ids, repr(text)
    assert known.encode(pa.array([], pa.string()))[0].tolist() == []


def test_displaced_words_are_learned_again(monkeypatch):
    monkeypatch.setattr(packing, "KNOWN", 1 << 4)
    known = packing.Words(vocabulary()[0])
    for seed in range(3):
        batch = texts(seed, 30)
        flat, cuts = known.encode(pa.array(batch, pa.string()))
        assert [flat[a:b].tolist() for a, b in zip(cuts[:-1], cuts[1:])] == [known.whole.encode(t or "", add_special_tokens=False).ids for t in batch]


def test_latin_letters_by_their_bytes():
    for code in range(1, 0x250):
        if not 0xD800 <= code < 0xE000:
            body = np.frombuffer(chr(code).encode(), np.uint8)
            own = packing._letters(body)
            assert own.all() == own.any() and own.all() == (code not in (0x130,) and chr(code).isalpha() and (code < 0x80 or 0xC0 <= code < 0x180))
