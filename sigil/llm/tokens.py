"""Token ids of the word-end BPE vocabulary, cached by word.

The vocabulary drops white space, and none of its normalising steps reaches across ASCII
white space, so the ids of a text are those of its words in order. A word is lower-cased
and split into letter runs, digits and other runs as the vocabulary's own rule does, and
each part runs through the BPE model once. Both caches outlive a task within its worker and
are bounded: of two generations of words the older one goes when the younger one is full, and
words of more than LONG bytes are not kept.
"""

from __future__ import annotations

import itertools
from array import array

import numpy as np
import public_tokenizers
import regex
from tokenizers import Tokenizer

VOCABULARY = "word_bpe_49k.json"
#: Bytes of a word, or letters of a part, that a cache keeps at most.
LONG = 64

#: The vocabulary's rule for parts of a word (fixed by its file).
_PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: Words beyond this letter go through the whole tokenizer: their normal forms need its tables.
_LATIN = "ɐ"


def _byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: itself if it shows, else the next from U+0100."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = itertools.count(256)
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class WordTokenizer:
    """many(texts) equals Tokenizer.encode(text, add_special_tokens=False).ids as uint32."""

    def __init__(self, path: str, limit: int = 120_000) -> None:
        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.letters = _byte_letters()
        self.limit = limit
        # Two generations each: what the older one still serves moves to the younger one.
        self.words: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def _part(self, part: str) -> bytes:
        text = part if part.isascii() else "".join(self.letters[b] for b in part.encode())
        found = array("I", [x.id for x in self.model.tokenize(text)]).tobytes()
        if len(part) <= LONG:
            self.parts[part] = found
        return found

    def _word(self, raw: bytes) -> bytes:
        word = raw.decode()
        known = self.parts
        if word.isascii():
            if word.isalpha():
                low = word.lower()
                return known.get(low) or self._part(low)
            plain = word.isprintable() and "<|" not in word
        else:
            plain = word.isprintable() and "<|" not in word and max(word) < _LATIN
        if not plain:
            return np.array(self.whole.encode(word, add_special_tokens=False).ids, np.uint32).tobytes()
        return b"".join([known.get(p) or self._part(p) for p in _PARTS.findall(word.lower())])

    def learn(self, words: set[bytes]) -> None:
        """Makes the ids of these words known."""
        if len(self.parts) > 4 * self.limit:
            self.parts.clear()
        if len(self.words) > self.limit:
            self.words, self.older = {}, self.words
        known, older, find = self.words, self.older, self._word
        for word in words.difference(known):
            known[word] = older.get(word) or find(word)

    def many(self, texts: list[str]) -> list[np.ndarray]:
        split = [t.encode().split() for t in texts]
        distinct = set(itertools.chain.from_iterable(split))
        rare = {w: self._word(w) for w in distinct if len(w) > LONG}
        self.learn(distinct.difference(rare))
        known = self.words.__getitem__
        get = (lambda w: rare.get(w) or known(w)) if rare else known
        return [np.frombuffer(b"".join(map(get, words)), np.uint32) for words in split]


_OPEN: dict[str, WordTokenizer] = {}


def tokenizer(path: str | None = None) -> WordTokenizer:
    """One for each process and vocabulary file; Python workers keep it between tasks."""
    path = path or public_tokenizers.path(VOCABULARY)
    if path not in _OPEN:
        _OPEN[path] = WordTokenizer(path)
    return _OPEN[path]
