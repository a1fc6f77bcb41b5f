"""Token ids by a public tokenizer file, through a bounded memory of words."""

from __future__ import annotations

import string
import unicodedata
from functools import lru_cache

import numpy as np

#: Words remembered by a Python worker, twice over; older ones are forgotten. Results do not depend on it.
REMEMBERED_WORDS = 200_000
#: Punctuation that, after letters, is a pre-token of its own; an apostrophe may not be.
_AFTER = string.punctuation.replace("'", "").encode()


class WordTokenizer(dict):
    """Ids of a tokenizer that never lets a token cross white space, and folds case.

    Words are the runs between ASCII white space, so the ids of a text are the
    ids of its words in order. The dictionary maps a word's bytes to its ids as
    little-endian unsigned 32-bit numbers.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.model = Tokenizer.from_file(path)
        self.older: dict[bytes, bytes] = {}
        vocabulary = self.model.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def ids(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text as bytes."""
        # Special tokens are told by case, so a text that may hold one keeps it.
        split = [(text if b"<|" in text else text.lower()).split() for text in texts]
        if len(self) > REMEMBERED_WORDS:
            self.older = dict(self)
            self.clear()
        missing = set()
        for words in split:
            missing.update(words)
        self.learn([word for word in missing if word not in self])
        return [b"".join(map(self.__getitem__, words)) for words in split]

    def learn(self, words: list[bytes]) -> None:
        """Letters followed by punctuation are two parts; letters alone are encoded many at once, the rest one by one."""
        cores, odd, joined = {}, [], []
        for word in words:
            known = self.older.get(word)
            if known is not None:
                self[word] = known
                continue
            core = word.rstrip(_AFTER)
            if core.isascii():
                plain = core.isalpha()
            else:
                text = core.decode("utf-8", "replace")
                plain = text.isalpha() and text.lower().isalpha() and unicodedata.is_normalized("NFC", text)
            if not plain:
                odd.append(word)
            else:
                joined.append((word, core))
                cores[core] = b""
        wanted = []
        for core in cores:
            known = self.get(core) or self.older.get(core)
            if known:
                cores[core] = known
            else:
                wanted.append(core)
        for start in range(0, len(wanted), 500):
            part = wanted[start : start + 500]
            ids = np.array(self._encode(b" ".join(part)), "<u4")
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) != len(part):  # not one pre-token each after all
                odd += part
                continue
            raw, begin = ids.tobytes(), 0
            for core, end in zip(part, (4 * ends).tolist()):
                cores[core] = raw[begin:end]
                begin = end
        for word in odd:
            cores[word] = self[word] = np.array(self._encode(word), "<u4").tobytes()
        for word, core in joined:
            after = word[len(core) :]
            if after and after not in self:
                self[after] = np.array(self._encode(after), "<u4").tobytes()
            self[word] = cores[core] + self[after] if after else cores[core]

    def _encode(self, text: bytes) -> list[int]:
        return self.model.encode_batch_fast([text.decode("utf-8", "replace")], add_special_tokens=False)[0].ids


@lru_cache(maxsize=2)
def word_tokenizer(path: str) -> WordTokenizer:
    """One per Python worker and file."""
    return WordTokenizer(path)


def vocabulary_file(name: str) -> str:
    """The place of a public vocabulary file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name) if "/" not in name else name
