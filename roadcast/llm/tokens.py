"""Token ids of whole texts by a public tokenizer file.

The file's own library encodes any text. Most texts are plain, that is in Latin letters
without combining marks, and for a byte-level vocabulary with word ends a second library
applies the file's merges to them several times faster: the text is lower-cased and split
by the file's pattern, and a blank behind each part stands for the word end.

Both give the same ids. The second library joins neighbours by the rank of what they
make together, the first by the rank of the pair; these agree where every entry of the
vocabulary comes out of its own pair, which holds for a vocabulary that was trained. Each
task compares a part of the vocabulary before it relies on that, else it does without.
"""

from __future__ import annotations

import json
import re
import unicodedata

import numpy as np

_FIRST_FAR = 0x250  # letters from here on may be composed, decomposed or change length


def _plain_characters() -> str:
    """Near characters whose lower case is one near character; not the control characters
    that only one of the libraries takes for white space."""
    near = (chr(c) for c in range(_FIRST_FAR) if not 0x1C <= c <= 0x1F)
    return "".join(c for c in near if len(c.lower()) == 1 and ord(c.lower()) < _FIRST_FAR)


_FAR = re.compile(f"[^{re.escape(_plain_characters())}]")
_LONGEST = 2000  # longer parts are left to the file's own library
# Fixed values of the vocabulary files: the characters that stand for bytes.
_SHOWN_BYTES = [*range(33, 127), *range(161, 173), *range(174, 256)]


def _byte_of() -> dict[str, int]:
    hidden = [b for b in range(256) if b not in set(_SHOWN_BYTES)]
    return {chr(b): b for b in _SHOWN_BYTES} | {chr(256 + k): b for k, b in enumerate(hidden)}


def _class(first: str) -> str:
    near = (chr(c) for c in range(33, _FIRST_FAR))
    return "".join(re.escape(c) for c in near if unicodedata.category(c)[0] == first)


class Encoder:
    """``path`` names a tokenizer file; ``end`` is the id put behind every text."""

    def __init__(self, path: str, end: int):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._end = np.array([end], "<u4").tobytes()
        self._merges = self._split = None
        try:
            self._prepare(json.load(open(path, encoding="utf-8")))
        except (KeyError, TypeError):  # a file of another kind
            self._merges = None

    def _prepare(self, file: dict) -> None:
        import tiktoken

        model, splitting = file["model"], file["pre_tokenizer"]["pretokenizers"][0]
        steps = [s["type"] for s in file["normalizer"]["normalizers"]]
        suffix, vocabulary = model["end_of_word_suffix"], model["vocab"]
        if steps != ["NFC", "Replace", "Lowercase"] or not suffix or splitting["type"] != "Split":
            return
        byte_of = _byte_of()

        def raw(token: str) -> bytes:
            stem = token.removesuffix(suffix)
            return bytes(byte_of[c] for c in stem) + (b" " if stem != token else b"")

        special = {t["content"] for t in file["added_tokens"]}
        ids = {raw(t): i for t, i in vocabulary.items() if t not in special}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        # Bytes first, then bytes that end a word, so that word ends are put on first.
        order = [bytes([b]) for b in range(256)]
        order += [bytes([b]) + b" " for b in range(256) if b != 32]
        order += [raw(a + b) for a, b in pairs]
        ranks = {token: k for k, token in enumerate(dict.fromkeys(order))}
        self._ids_by_rank = np.array([ids.get(t, 0) for t in ranks], "<u4")
        pattern = splitting["pattern"]["Regex"]
        if "[\\p{" not in pattern:  # the classes below are meant to stand in brackets
            return
        for name, first in (("\\p{L}", "L"), ("\\p{N}", "N")):
            pattern = pattern.replace(name, _class(first))
        self._split = re.compile(pattern)
        self._merges = tiktoken.Encoding("merges", pat_str="[^ ]+ ", mergeable_ranks=ranks, special_tokens={})
        words = [raw(t).decode("utf-8", "ignore").strip() for t in list(vocabulary)[512::40] if t.endswith(suffix)]
        sample = " ".join(w for w in words if w and not _FAR.search(w))
        if self._plain(sample) != self._any(sample):
            self._merges = None

    def _any(self, text: str) -> bytes:
        ids = self._tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return np.array(ids, "<u4").tobytes()

    def _plain(self, text: str) -> bytes:
        parts = self._split.findall(text.lower())
        if max(map(len, parts), default=0) > _LONGEST:
            return self._any(text)
        parts.append("")  # the last part has its end, too
        ranks = self._merges.encode_ordinary(" ".join(parts))
        return self._ids_by_rank[np.array(ranks, np.int64)].tobytes()

    def encode(self, text: str) -> bytes:
        """The ids of a text and the end id, as little-endian 32-bit numbers."""
        # "<|" could begin a special token.
        plain = self._merges is not None and "<|" not in text and not _FAR.search(text)
        return (self._plain(text) if plain else self._any(text)) + self._end
