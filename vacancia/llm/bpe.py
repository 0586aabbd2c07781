"""Byte-level BPE through the tokenizers library: ids of whole texts, and a cache of whole pre-token groups.

Whole texts are encoded by tiktoken where the file's merges stand in the order of their ids, as its
ranks do: the ids are the same, at a quarter of the time. Its pattern is searched without the
look-ahead of ``\\s+(?!\\S)``, which is slow: that one only parts the last blank of a run from the run if
text follows, so a text with such a run is cut there first.

For lookups: such a tokenizer cuts a text into pre-tokens before it merges, and none of them holds a space
after another character. A space between two non-blank characters is therefore always the
start of a pre-token, so the text may be cut there and each group (" word," say) encoded on its
own: the ids are those of the whole text. Groups repeat, so most become one dictionary lookup.
"""

from __future__ import annotations

import functools
import itertools
import json
import os
import re
from array import array

import numpy as np
import regex

# How the byte-level scheme cuts pre-tokens and shows bytes as characters.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# The same for texts in which no blank follows a blank, unless to the end of the text.
_PLAIN_PRE_TOKEN = PRE_TOKEN.replace(r"\s+(?!\S)|", "")
_BLANKS = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_RUN_ENDS = re.compile(f"(?<=[{_BLANKS}])(?=[{_BLANKS}][^{_BLANKS}])")
# First bytes in UTF-8 of the blanks beyond ASCII.
_WIDE_BLANKS = (0xC2, 0xE1, 0xE2, 0xE3)
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_CHARS = {b: chr(b) for b in _SHOWN} | {b: chr(256 + i) for i, b in enumerate(sorted({*range(256)} - {*_SHOWN}))}

SIMPLE_ENDS = (".", ",", ";", ":", "!", "?")

CLEAN = re.compile(r"(?<=\S) (?=\S)")
#: Longest group that is remembered, how many groups and how many single pre-tokens are.
CACHED_CHARS, CACHED_GROUPS, CACHED_TOKENS = 40, 700_000, 300_000


def default_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Library:
    """The library's own ids of whole texts: tokenizers for .json, sentencepiece for .model."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.splits, self.specials, self.ordinary = False, [], None
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encode_all = lambda texts: model.encode(texts, num_threads=1)
            return
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.encode_all = lambda texts: [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        parts = json.loads(self.tokenizer.to_str())
        pre = parts.get("pre_tokenizer") or {}
        special_ids = {t["content"]: t["id"] for t in parts.get("added_tokens", [])}
        self.specials = list(special_ids)
        self.splits = (
            parts.get("normalizer") is None and parts["model"]["type"] == "BPE" and pre.get("type") == "ByteLevel"
            and bool(pre.get("use_regex", True)) and not pre.get("add_prefix_space", True)
        )
        self.pattern = regex.compile(PRE_TOKEN)
        self.ordinary = _ranked(parts["model"], special_ids) if self.splits else None

    def ids(self, text: str) -> np.ndarray:
        """Ids of a whole text; special strings in it count as the library takes them."""
        if self.ordinary is not None and not any(s in text for s in self.specials):
            return self.plain_ids(text)
        return _ids(self.encode_all([text])[0])

    def plain_ids(self, text: str) -> np.ndarray:
        """Ids of a whole text in which special strings are plain text."""
        if self.ordinary is not None:
            parts = [self.ordinary.encode_to_numpy(t, disallowed_special=()) for t in clean_runs(text)]
            return parts[0] if len(parts) == 1 else np.concatenate(parts)
        self.tokenizer.encode_special_tokens = True
        try:
            return _ids(self.encode_all([text])[0])
        finally:
            self.tokenizer.encode_special_tokens = False


def clean_runs(text: str) -> list[str]:
    """The text, cut before each blank that follows a blank and comes before another character."""
    data = text.encode()
    if not text.isascii() and any(lead in data for lead in _WIDE_BLANKS):
        codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
        blank = (codes <= 32) | (codes == 0x85) | (codes == 0xA0) | (codes == 0x1680) | (codes - 0x2000 < 0x60) | (codes == 0x3000)
    else:
        blank = np.frombuffer(data, np.uint8) <= 32
    # All blanks, and some more; the pattern is exact.
    return _RUN_ENDS.split(text) if (blank[1:] & blank[:-1]).any() else [text]


def _ranked(model: dict, specials: dict[str, int]):
    """The same tokenizer by ranks, if each merge makes the token whose id is next; else None.

    It knows the special strings, but takes them as plain text: without any it looks for the empty one at every character.
    """
    import tiktoken

    vocab, bytes_of = model["vocab"], {c: b for b, c in BYTE_CHARS.items()}
    made = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    first = 256
    if any(vocab.get(t) != first + k for k, t in enumerate(made)) or any(vocab.get(c, first) >= first for c in bytes_of):
        return None
    ranks = {bytes(bytes_of[c] for c in t): i for t, i in vocab.items() if t not in specials}
    return tiktoken.Encoding("ranked", pat_str=_PLAIN_PRE_TOKEN, mergeable_ranks=ranks, special_tokens=specials)


def _ids(ids: list[int]) -> np.ndarray:
    return np.asarray(ids, dtype="<u4")


def n_ids(data: bytes) -> int:
    return len(data) // 4


def blank_edge(piece: str) -> bool:
    return not piece or piece[0].isspace() or piece[-1].isspace()


class Groups:
    """Cuts texts into groups and looks each up; ``convert`` turns the bytes of a group's ids into what is remembered.

    ``frequent`` is an optional first tier, fixed for the task; the second fills as groups are met.
    """

    def __init__(self, path: str, convert, frequent: dict | None = None):
        self.library, self.convert = Library(path), convert
        self.frequent, self.known, self.heads, self.tokens = frequent or {}, {}, {}, {}

    def cut(self, text: str) -> list[str]:
        """The head and then groups that each follow one space."""
        pieces = text.split(" ")
        if pieces[0][-1:].isspace() or len(pieces) == 1:
            return CLEAN.split(text)
        return pieces

    def _token(self, token: str) -> bytes:
        """Ids of one pre-token."""
        data = self.tokens.get(token)
        if data is None:
            if token.isascii() and token.isprintable():
                mapped = token.replace(" ", BYTE_CHARS[32])
            else:
                mapped = "".join(map(BYTE_CHARS.__getitem__, token.encode()))
            data = array("I", [t.id for t in self.library.tokenizer.model.tokenize(mapped)]).tobytes()
            if len(token) <= CACHED_CHARS:
                self.tokens[token] = data
        return data

    def _group(self, piece: str) -> bytes:
        """Ids of a space and a cleanly bounded piece: those of its pre-tokens (letters alone are one)."""
        if piece.isalpha():
            return self._token(" " + piece)
        if piece[-1:] in SIMPLE_ENDS and piece[:-1].isalpha():
            return self._token(" " + piece[:-1]) + self._token(piece[-1])
        return b"".join(map(self._token, self.library.pattern.findall(" " + piece)))

    def _fresh(self, groups: list[str]) -> dict:
        """Values of groups, each read with the space before it."""
        if len(self.tokens) > CACHED_TOKENS:
            self.tokens = dict(itertools.islice(self.tokens.items(), CACHED_TOKENS // 2, None))
        return {g: self.convert(self._group(g)) for g in groups}

    def _head(self, head: str):
        value = self.heads.get(head)
        if value is None:
            value = self.convert(_ids(self.library.encode_all([head])[0]).tobytes())
            if len(head) <= CACHED_CHARS and len(self.heads) < CACHED_GROUPS // 4:
                self.heads[head] = value
        return value

    def values(self, texts: list[str | None]) -> list[list]:
        """For each text the values of its parts in order; a null text has none."""
        if len(self.known) > CACHED_GROUPS:  # the older half goes
            self.known = dict(itertools.islice(self.known.items(), CACHED_GROUPS // 2, None))
        cut, missing, out = [], set(), []
        first, second = self.frequent.get, self.known.get

        def look(groups):
            if not self.frequent:
                return list(map(second, groups))
            found = list(map(first, groups))
            return [second(g) if v is None else v for g, v in zip(groups, found)] if None in found else found

        for text in texts:
            if not text:
                cut.append(None)
            elif not self.library.splits or any(s in text for s in self.library.specials):
                cut.append(text)
            else:
                pieces = self.cut(text)
                values = look(pieces[1:])
                if None in values:
                    new = [p for p, v in zip(pieces[1:], values) if v is None and p not in missing]
                    if any(not p.isalpha() and blank_edge(p) for p in new):
                        pieces = CLEAN.split(text)
                        values = look(pieces[1:])
                        new = [p for p, v in zip(pieces[1:], values) if v is None]
                    missing.update(new)
                cut.append((pieces, values))
        fresh = self._fresh(list(missing)) if missing else {}
        for item in cut:
            if item is None:
                out.append([])
            elif isinstance(item, str):
                out.append([self.convert(_ids(self.library.encode_all([item])[0]).tobytes())])
            else:
                pieces, values = item
                if None in values:
                    values = [fresh[p] if v is None else v for p, v in zip(pieces[1:], values)]
                out.append([self._head(pieces[0]), *values])
        self.known.update((g, v) for g, v in fresh.items() if len(g) <= CACHED_CHARS and (g.isalpha() or not blank_edge(g)))
        return out


@functools.lru_cache(maxsize=1)
def library(path: str) -> Library:
    """The worker's encoder; it outlives the task."""
    return Library(path)


def encode(path: str, texts: list[str | None]) -> list[np.ndarray]:
    """Ids of each whole text, unsigned 32-bit; a null text has none."""
    lib = library(path)
    if lib.ordinary is None:
        ids = iter(lib.encode_all([t for t in texts if t]))
        return [_ids(next(ids) if t else []) for t in texts]
    return [lib.ids(t) if t else _ids([]) for t in texts]
