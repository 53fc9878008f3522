"""New words of some texts are read by the automaton together, and what was learned of pairs is kept."""

import public_tokenizers
from tokenizers import Tokenizer

from levelscope.llm import bpe_codec

FILE = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "the unbelievable Zwölfton-Quartett 漢字仮名 ﷺ ÿ߿￿",
    "", "x", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaab qzxjkvwpqzxjkvwp 1234567890 !!!???...", "don't they'll \U0001f600\U0001f9ff",
]


class Counting:
    def __init__(self, automaton):
        self.automaton, self.reads = automaton, 0

    def iter(self, symbols):
        self.reads += 1
        return self.automaton.iter(symbols)


def make():
    with open(FILE, encoding="utf-8") as file:
        return bpe_codec.Codec(file.read())


def test_words_are_read_together():
    codec, library = make(), Tokenizer.from_file(FILE)
    codec.automaton = Counting(codec.automaton)
    ids, counts = codec.encode(TEXTS)
    want = [library.encode(text, add_special_tokens=False).ids for text in TEXTS]
    assert ids.tolist() == [i for text in want for i in text]
    assert counts.tolist() == [len(text) for text in want]
    assert codec.automaton.reads == 1
    codec.encode(TEXTS)
    assert codec.automaton.reads == 1


def test_pairs_outlive_the_words():
    codec = make()
    first, _ = codec.encode(TEXTS)
    codec._reset()  # as when the cache of words is full
    assert "unbelievable" not in codec.codes
    asked, fits = [], codec.fits
    codec.fits = lambda a, b: asked.append((a, b)) or fits(a, b)
    again, _ = codec.encode(TEXTS)
    assert again.tolist() == first.tolist()
    assert not asked
