"""Token ids of whole texts, by the tokenizers library, inside tasks.

Byte-level BPE merges never cross the tokenizer's pre-token boundaries, so a text's ids are its
pre-tokens' ids in a row.  ``Encoder`` cuts a text at those boundaries and has the library encode each
distinct pre-token once per task (prose repeats its words), which takes about half the time of encoding
every text whole.  Texts with characters outside ``PLAIN``, for which the cutting pattern and the
library's are not known to agree, are encoded whole by the library.  Special tokens' strings in a text
are ordinary text.  The ids are the same either way; a test compares them.
"""

from __future__ import annotations

import os
import re
import sys
from array import array
from collections.abc import Iterable, Iterator
from itertools import compress
from operator import not_

#: Pre-token boundaries of the byte-level BPE, for texts of plain characters only.
_WORDS = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ɏ]+|'(?:s|t|re|ve|m|ll|d)| ?[0-9]+| ?[^\sA-Za-zÀ-ÖØ-öø-ɏ0-9]+|\s+(?!\S)|\s+")
#: Anything else: the text is encoded whole.
_OTHER = re.compile(r"[^\t\n\r\x20-\x7e¡-©«-±´¶-¸»¿-ɏ‐-‧€]")


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def _bytes(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit ids (``array`` takes a short list in half of numpy's time)."""
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class Encoder:
    """Ids of texts as bytes (little-endian unsigned 32-bit)."""

    #: Distinct pre-tokens remembered, the earliest ones; others are encoded again for each group of texts.
    REMEMBERED = 500_000
    #: Characters of the texts handled together.
    GROUP = 2 << 20

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """The library's ids of each string, encoded whole."""
        return [_bytes(x.ids) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def batch(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """Ids of each text (null: none)."""
        group: list[str] = []
        held = 0
        for t in texts:
            group.append(t or "")
            held += len(t or "")
            if held > self.GROUP:
                yield from self._group(group)
                group, held = [], 0
        yield from self._group(group)

    def _group(self, texts: list[str]) -> Iterator[bytes]:
        known, looked, waiting = self.known, [], set()
        for t in texts:
            if _OTHER.search(t):
                looked.append((None, []))
                continue
            words = _WORDS.findall(t)
            ids = list(map(known.get, words))
            missed = list(compress(words, map(not_, ids)))  # no pre-token is without ids
            looked.append((ids, missed))
            waiting.update(missed)
        new, found = list(waiting), {}
        for i in range(0, len(new), 20_000):
            found.update(zip(new[i : i + 20_000], self.encode(new[i : i + 20_000])))
        for t, (ids, missed) in zip(texts, looked):
            if ids is None:
                yield self.encode([t])[0]
                continue
            at = -1
            for word in missed:
                at = ids.index(None, at + 1)
                ids[at] = found[word]
            yield b"".join(ids)
        if len(known) + len(found) <= self.REMEMBERED:
            known.update(found)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This worker's encoder for a vocabulary file; what it remembers serves its later tasks too."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
