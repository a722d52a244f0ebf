"""Token ids of whole texts by a public tokenizer, with a bounded cache of words.

Both vocabularies cut a text into pieces before any merge, and no piece reaches over white space into the next word but for the one
blank before a word. A text whose only white space is single blanks and single line ends between words is therefore the
sequence of its words' ids; the library encodes each distinct word once per worker. Any other text goes through
the library whole. Names of special tokens inside a text are ordinary text.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Collection

import numpy as np

# Words kept in either half of the cache.
CACHED_WORDS = 250_000
# Words of letters encoded as one text.
GROUP = 64
# Marks that may follow letters; the apostrophe is left out, since some pieces begin with it.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def latin(text: str) -> bool:
    """Whether all characters are of Latin-1, which compose with nothing and have lower cases of one character."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class Encoder:
    """ids(texts) gives each text's ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, vocabulary: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        import public_tokenizers
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(vocabulary) if os.sep not in vocabulary else vocabulary)
        self.tokenizer.encode_special_tokens = True
        # the vocabulary's own lower-casing, done before the words are looked up where it is sure to be the same
        self.lowers = self.encode(["A\u00c9"]) == self.encode(["a\u00e9"])
        # ids that begin a word (their token has the blank) or end it (the vocabulary marks ends)
        tokens = self.tokenizer.get_vocab()
        self.edge_ends = "a</w>" in tokens
        self.edge = np.zeros(max(tokens.values()) + 1, bool)
        self.edge[[i for t, i in tokens.items() if (t.endswith("</w>") if self.edge_ends else t.startswith("\u0120"))]] = True
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.ends: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [struct.pack(f"<{len(x)}I", *x.ids) for x in found]

    def ids(self, texts: list[str]) -> list[bytes]:
        out: list = [b""] * len(texts)
        split = {}
        for i, text in enumerate(texts):
            if self.lowers and latin(text):
                text = text.lower()
            if text and " ".join(text.split()) == text.replace("\n", " "):
                # a word keeps the white space before it: "\n" as it is, a blank as none, the first word a mark
                words = text.replace("\n", " \n").split(" ")
                words[0] = "\r" + words[0]
                split[i] = words
            elif text:
                out[i] = self.encode([text])[0]
        # the new words of all texts are looked up and encoded together
        cache, older = self.cache, self.older
        new = set().union(*split.values()) - cache.keys()
        known = new & older.keys()
        cache.update({w: older[w] for w in known})
        self.learn(new - known)
        for i, words in split.items():
            out[i] = b"".join(map(cache.__getitem__, words))
        if len(cache) > CACHED_WORDS:  # words of lasting use come back from the older half
            self.cache, self.older = {}, cache
        return out

    def learn(self, words: Collection[str]) -> None:
        """Encode new words.

        Letters and the marks that follow them are separate pieces in both vocabularies, so a word of that form is its letters'
        ids and its marks' ids.
        """
        cache, ends, stems = self.cache, self.ends, {}
        letters, others = set(), []
        for w in words:
            if w.isalpha():
                letters.add(w)
                continue
            stem = w.rstrip(MARKS)
            if stem.isalpha():
                stems[w] = stem
            else:
                others.append(w)
        letters.update(s for s in stems.values() if s not in cache)
        self.learn_letters(list(letters))
        cache.update(zip(others, self.encode([w[1:] if w[:1] == "\r" else w if w[:1] == "\n" else " " + w for w in others]), strict=True))
        for w, stem in stems.items():
            end = w[len(stem) :]
            if end not in ends:
                ends[end] = self.encode([end])[0]
            cache[w] = cache[stem] + ends[end]

    def learn_letters(self, words: list[str]) -> None:
        """Encode words of letters, many to a text, and part the ids where a word begins or ends.

        A text whose ids don't show as many words as it has is encoded word by word.
        """
        groups = [words[i : i + GROUP] for i in range(0, len(words), GROUP)]
        found = self.tokenizer.encode_batch_fast([" " + " ".join(g) for g in groups], add_special_tokens=False)
        for group, x in zip(groups, found, strict=True):
            ids = np.array(x.ids, dtype="<u4")
            edges = np.flatnonzero(self.edge[ids])
            bounds = [0, *(edges + 1)] if self.edge_ends else [*edges, len(ids)]
            if len(bounds) != len(group) + 1 or bounds[0] != 0 or bounds[-1] != len(ids):
                self.cache.update(zip(group, self.encode([" " + w for w in group]), strict=True))
                continue
            raw, at = ids.tobytes(), [4 * int(b) for b in bounds]
            self.cache.update(zip(group, [raw[a:b] for a, b in zip(at, at[1:], strict=False)], strict=True))


_encoders: dict[str, Encoder] = {}


def encoder(vocabulary: str) -> Encoder:
    """The worker's encoder of a vocabulary."""
    if vocabulary not in _encoders:
        _encoders[vocabulary] = Encoder(vocabulary)
    return _encoders[vocabulary]
