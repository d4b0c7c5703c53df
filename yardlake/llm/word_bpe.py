"""Token ids of whole texts by a word-level tokenizer file, word by word with a memo.

The tokenizer drops white space, ignores case and never joins letters with other signs, so a text's ids are those of its
white-space-separated chunks one after the other, and a word's closing full stop or comma can be encoded on its own.
Chunks are encoded once per worker as long as they are kept. ASCII letters are lowered and ASCII white space is split here;
all other cases of either are left to the tokenizer.
"""

from __future__ import annotations

import os
from array import array
from unicodedata import is_normalized

import numpy as np
import public_tokenizers

NAME = "word_bpe_49k.json"
#: A special token of the file; no chunk without its first two characters has its id.
SEPARATOR = "<|endoftext|>"
#: Chunks kept per worker, some 150 MB.
MEMO = 800_000
#: Chunks that the tokenizer gets as one string, with a special token between them.
JOINED = 256
#: The signs that stand for bytes in the file: printable ones for themselves, the others from 256 on.
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_SIGNS = dict(zip([b for b in range(256) if b not in PRINTABLE], range(256, 512), strict=False))


class Encoder:
    """encode(texts) -> one uint32 array of ids per text, which may be str, UTF-8 bytes or None."""

    def __init__(self, file: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file or public_tokenizers.path(NAME))
        self.model = self.tokenizer.model
        self.separator = self.tokenizer.token_to_id(SEPARATOR)
        self.memo: dict[bytes, bytes] = {}

    def _plain(self, text: bytes | str) -> bytes:
        raw = text.encode("utf-8", "replace") if isinstance(text, str) else text
        return raw if b"<|" in raw else raw.lower()  # special tokens are told by their case

    def _alone(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, new: set[bytes]) -> None:
        memo = self.memo
        closed = [c for c in new if c[-1:] in (b".", b",") and c[-2:-1].isalpha()]
        bare = new.difference(closed).union(c[:-1] for c in closed).difference(memo)
        plain = []
        for chunk in bare:
            word = chunk.decode()
            if word.isalpha() and word == word.lower() and (word.isascii() or is_normalized("NFC", word)):
                # one word in its final form: nothing to normalize or split, so the merges alone do
                ids = [t.id for t in self.model.tokenize(chunk.decode("latin-1").translate(BYTE_SIGNS))]
                memo[chunk] = array("I", ids).tobytes()
            elif b"<|" not in chunk:
                plain.append(chunk)
        for at in range(0, len(plain), JOINED):
            group = plain[at : at + JOINED]
            joined = SEPARATOR.join([c.decode() for c in group])
            ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
            cuts = [-4, *(4 * np.flatnonzero(ids == self.separator)).tolist(), 4 * len(ids)]
            raw = ids.tobytes()
            for chunk, i, j in zip(group, cuts, cuts[1:], strict=False):
                memo[chunk] = raw[i + 4 : j]
        for chunk in bare:
            if chunk not in memo:
                memo[chunk] = self._alone(chunk.decode())
        ends = {end: self._alone(end.decode()) for end in (b".", b",")} if closed else {}
        for chunk in closed:
            memo[chunk] = memo[chunk[:-1]] + ends[chunk[-1:]]

    def encode(self, texts: list) -> list[np.ndarray]:
        chunks = [self._plain(t).split() if t else [] for t in texts]
        if len(self.memo) > MEMO:
            self.memo.clear()
        new = set().union(*chunks).difference(self.memo)
        if new:
            self._learn(new)
        get = self.memo.__getitem__
        return [np.frombuffer(b"".join(map(get, part)), "<u4") for part in chunks]


_encoders: dict[str | None, Encoder] = {}


def encoder(file: str | None = None) -> Encoder:
    """The worker's own, kept from task to task."""
    if file not in _encoders:
        _encoders[file] = Encoder(file)
    return _encoders[file]
