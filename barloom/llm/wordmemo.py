"""Token ids of whole texts from the public tokenizers, with a memo for each distinct word.

Both tokenizers cut at white space before they merge, so the ids of a text are those of its words one after
the other. A word that was met before costs one dictionary lookup; only new words reach the library. Texts
whose white space could matter to the tokenizer are given to the library whole.
"""

from __future__ import annotations

import hashlib
import os
import re
from codecs import charmap_decode
from struct import pack

#: Entries kept by a worker before it starts anew, and characters of the longest word that is kept: bound memory, never change
#: a result.
MEMO_ENTRIES, MEMO_CHARS = 200_000, 64

#: Letters that are one code point under NFC and whose lower case is one code point, and marks that may follow them.
_LETTERS = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+\Z").match
_MARKS = ".,!?;:|$%&*#"
_WORDS = re.compile(r"[^\t-\r ]+").findall
#: Controls at which str.split cuts and the tokenizer does not.
_SEPARATORS = re.compile("[\x1c-\x1f]").search


def _byte_chars() -> list[str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others follow from 256 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


_CHARS = "".join(_byte_chars())


def file_version(path: str) -> str:
    """Digest of the vocabulary file and of the library that reads it."""
    import tokenizers

    with open(path, "rb") as f:
        return hashlib.sha256(f.read() + tokenizers.__version__.encode()).hexdigest()


class _Known(dict):
    """What each word stands for; a word that is not there is worked out, and kept if it is not long."""

    def __init__(self, find):
        super().__init__()
        self.find = find

    def __missing__(self, word: str):
        got = self.find(word)
        if len(word) <= MEMO_CHARS:
            self[word] = got
        return got


class _Memo:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize
        self.known = _Known(self._word)
        self.parts: dict[str, bytes] = {}

    def _library(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return pack(f"<{len(ids)}I", *ids)

    def _part(self, pretoken: str) -> bytes:
        """Ids of one pretoken, merged by the library's model, as little-endian uint32 bytes."""
        got = self.parts.get(pretoken)
        if got is None:
            if len(self.parts) > MEMO_ENTRIES:
                self.parts.clear()
            chars = pretoken if pretoken.isascii() and " " not in pretoken else charmap_decode(pretoken.encode(), "strict", _CHARS)[0]
            ids = [t.id for t in self.merge(chars)]
            got = pack(f"<{len(ids)}I", *ids)
            if len(pretoken) <= MEMO_CHARS:
                self.parts[pretoken] = got
        return got


class LowerWordIds(_Memo):
    """word_bpe_49k.json: lower case, white space dropped; the ids of a text as little-endian uint32 bytes."""

    def _word(self, word: str) -> bytes:
        core = word.rstrip(_MARKS)
        if core.isalpha() and (core.isascii() or _LETTERS(core)):
            ids = self._part(core.lower())
            return ids if len(core) == len(word) else ids + self._part(word[len(core) :])
        return self._library(word)

    def ids(self, text: str) -> bytes:
        words, known = _WORDS(text) if _SEPARATORS(text) else text.split(), self.known
        if len(known) > MEMO_ENTRIES:
            known.clear()
        return b"".join(map(known.__getitem__, words))


class ByteWordCounts(_Memo):
    """byte_bpe_50k.json: the number of tokens of a text."""

    def _word(self, word: str) -> int:
        """Tokens of a space-led or leading word; -1 where white space at its edges needs the whole text."""
        bare = word[1:] if word[:1] == " " else word
        core = bare.rstrip(_MARKS)
        if core.isalpha() and (core.isascii() or _LETTERS(core)):
            n = len(self._part(word[: len(word) - len(bare) + len(core)]))
            return (n if len(core) == len(bare) else n + len(self._part(bare[len(core) :]))) // 4
        if not bare or bare != bare.strip():
            return -1
        return len(self._library(word)) // 4

    def count(self, text: str) -> int:
        if not text:
            return 0
        known, total = self.known, 0
        if len(known) > MEMO_ENTRIES:
            known.clear()
        for line in text.split("\n"):
            first, *rest = line.split(" ")
            counts = [known[first], *map(known.__getitem__, [" " + w for w in rest])]
            if min(counts) < 0:
                return len(self._library(text)) // 4
            total += 1 + sum(counts)
        return total - 1


_made: dict[tuple[type, str], _Memo] = {}


def memo(kind: type, path: str):
    """One memo of a kind for each worker process."""
    if (kind, path) not in _made:
        _made[kind, path] = kind(path)
    return _made[kind, path]
