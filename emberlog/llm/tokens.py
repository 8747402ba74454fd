"""Token ids of whole texts with the tokenizers library, remembering the pieces it has encoded.

Byte-pair models encode each pre-token by itself, and no pre-token of the two supported layouts reaches
across the cuts made here, so a text's ids are its chunks' ids one after the other. Chunks repeat a lot:
Arrow cuts a group of texts and numbers its distinct chunks, and only those are looked up among the REMEMBERED
first ones that the worker has met (or as many as its job has memory for); if the texts change, it starts afresh.
A comma or full stop that ends a chunk of Latin letters is a chunk of its own.
Chunks of Latin letters, ASCII digits and signs go straight to the model, all others through the
whole tokenizer. An added token such as <|endoftext|> is its own id wherever it stands in a text, and the
stretches around it are encoded by themselves, as encode(text, add_special_tokens=False) does. ``tests/llm/test_operators.py`` compares with encoding whole texts.
"""

from __future__ import annotations

import re
from codecs import charmap_decode
from itertools import chain, repeat
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

REMEMBERED = 340_000  # about 50 MB in each worker; a dict grows at 349,525 entries
STRANGE = 0.3  # share of chunks never met from which a full memory starts afresh
BATCH_BYTES = 2_000_000
_BYTE_CHUNKS = re.compile(r" ?[^ \t\n\r\x0b\x0c]+|[ \t\n\r\x0b\x0c]+(?![^ \t\n\r\x0b\x0c])|[ \t\n\r\x0b\x0c]+")
# white space that is not one space or line feed between words
_ODD_SPACE = ("  ", " \n", "\n ", "\n\n", "\t", "\r", "\x0b", "\x0c", "\x00")
# letters up to U+017F (all composed), without the one whose lower case is two code points
_LETTERS = "A-Za-zÀ-ÖØ-öø-įı-ſ"
_SIGNS = r"!-&(-/:-@\[-`{-~"
# Arrow's expressions know no look-behind
_ENDS_WORD = r"([A-Za-z])([,.])([ \t\n\r\x0b\x0c]|$)"
_BYTE_PIECES = re.compile(f" ?[{_LETTERS}]+| ?[0-9]+| ?[{_SIGNS}]+")
_WORD = re.compile(f"[{_LETTERS}]+").fullmatch
_ID = attrgetter("id")
_WORD_PIECES = re.compile(f"[{_LETTERS}]+|[0-9]|[{_SIGNS}]+")
# white space outside ASCII and separators the libraries treat differently: such texts are encoded whole
_OTHER_SPACE = (
    *"\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000", *map(chr, range(0x2000, 0x200B)),
)
# byte-level models spell a byte as a letter: visible Latin-1 as itself, the others from U+0100 on in order
_VISIBLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_SPELLED = "".join([chr(b) if b in _VISIBLE else chr(256 + sum(x not in _VISIBLE for x in range(b))) for b in range(256)])


class Encoder:
    """One tokenizer file; ``ids`` gives an array of ids for each text."""

    def __init__(self, path: str, remembered: int | None = None):
        self.remembered = remembered
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        added = self.tokenizer.get_added_tokens_decoder()
        self.added = {t.content: number for number, t in added.items()}
        if any(t.single_word or t.lstrip or t.rstrip or t.normalized for t in added.values()):
            raise ValueError("added tokens must be matched as they stand")
        self.split = re.compile(f"({'|'.join(map(re.escape, sorted(self.added, key=len, reverse=True)))})").split
        # words: white space is dropped and letters are lower-cased; bytes: a space belongs to the next word
        self.by_words = bool(self.model.end_of_word_suffix)
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.flat = np.zeros(0, np.uint32)
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int32)

    def chunks(self, text: str) -> list[str]:
        """Keys of the chunks of a text that is not plain. Of byte-level text a key stands for itself with a space before it,
        unless it begins with white space, or with NUL, which is dropped. An added token has a space before it, as no other key."""
        if any(t in text for t in self.added):
            return [c for k, part in enumerate(self.split(text)) if part for c in ([" " + part] if k % 2 else self.chunks(part))]
        if self.by_words:
            return [c.decode() for c in text.encode().lower().split()]
        if any(c in text for c in _OTHER_SPACE):
            return ["\x00" + text]
        if any(c in text for c in _ODD_SPACE):
            return [c[1:] if c[0] == " " and c[1:] and c[1] not in "\x00\n \t\r\x0b\x0c" else "\x00" + c for c in _BYTE_CHUNKS.findall(text)]
        keys = text.replace("\n", " \n").split(" ")
        keys[0] = "\x00" + keys[0]
        return keys

    def _plain(self, text: str) -> bool:
        """Whether ``_cut`` may take a text."""
        if any(t in text for t in self.added):
            return False
        return self.by_words or not any(c in text for c in _ODD_SPACE) and (text.isascii() or not any(c in text for c in _OTHER_SPACE))

    def _cut(self, texts: list[str]) -> pa.ListArray:
        """Keys of the chunks of each of some plain texts."""
        if self.by_words:
            spaced = pc.replace_substring_regex(pc.ascii_lower(pa.array(texts, pa.string())), _ENDS_WORD, r"\1 \2\3")
            return pc.ascii_split_whitespace(spaced)
        spaced = pc.replace_substring(pa.array(["\x00" + t for t in texts], pa.string()), "\n", " \n")
        return pc.split_pattern(pc.replace_substring_regex(spaced, _ENDS_WORD, "\\1 \x00\\2\\3"), " ")

    def _spelled(self, text: str) -> str:
        return charmap_decode((text.lower() if self.by_words else text).encode(), "strict", _SPELLED)[0]

    def _encode(self, key: str) -> list[int]:
        tokenize = self.model.tokenize
        if key[:1] == " ":
            return [self.added[key[1:]]]
        if _WORD(key):  # a word of Latin letters is one piece
            return list(map(_ID, tokenize(self._spelled(key if self.by_words else " " + key))))
        if self.by_words:
            text = key
            pieces = _WORD_PIECES.findall(text)
        elif key[:1] == "\n":
            text = key
            pieces = ["\n", *_BYTE_PIECES.findall(key[1:])]
        else:
            text = key[1:] if key[:1] == "\x00" else " " + key
            pieces = [text] if text.isspace() and text.isascii() else _BYTE_PIECES.findall(text)
        if sum(map(len, pieces)) != len(text):
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        return [t.id for piece in pieces for t in tokenize(self._spelled(piece))]

    def _learn(self, new: list[str]) -> None:
        """Add the ids of chunks; only as many as may be remembered get into the index."""
        coded = [self._encode(c) for c in new]
        lengths = np.fromiter(map(len, coded), np.int32, len(coded))
        begin = len(self.flat) + np.cumsum(lengths) - lengths
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(coded), np.uint32, int(lengths.sum()))])
        self.starts, self.lengths = np.concatenate([self.starts, begin]), np.concatenate([self.lengths, lengths])
        known = len(self.index)
        self.index.update(zip(new[:max(0, self.most() - known)], range(known, self.most())))

    def most(self) -> int:
        return self.remembered or REMEMBERED

    def _shrink(self, strange: bool) -> None:
        """Keep the chunks met first, which are the frequent ones, unless the texts have become others."""
        most = len(self.index)
        if len(self.starts) == most:
            return
        if strange:
            self.forget()
            return
        self.starts, self.lengths = self.starts[:most].copy(), self.lengths[:most].copy()
        self.flat = self.flat[:self.starts[-1] + self.lengths[-1]].copy()

    def _group(self, texts: list[str]) -> list[np.ndarray]:
        plain = [k for k, t in enumerate(texts) if self._plain(t)]
        cut = self._cut([texts[k] for k in plain])
        sizes, others = np.zeros(len(texts), np.int64), []
        sizes[plain] = pc.list_value_length(cut).to_numpy()
        odd = np.setdiff1d(np.arange(len(texts)), plain)
        for k in odd:
            others.append(pa.array(self.chunks(texts[k]), pa.string()))
            sizes[k] = len(others[-1])
        coded = pa.concat_arrays([cut.flatten(), *others]).dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False)
        numbers = np.fromiter(map(self.index.get, distinct, repeat(-1)), np.int64, len(distinct))
        new = numbers < 0
        numbers[new] = len(self.index) + np.arange(np.count_nonzero(new))
        if new.any():
            self._learn(distinct[new].tolist())
        which = coded.indices.to_numpy()
        lengths = self.lengths[numbers][which]
        ends = np.cumsum(lengths, dtype=np.int64)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.repeat(self.starts[numbers][which] - (ends - lengths), lengths) + np.arange(total)]
        self._shrink(np.count_nonzero(new) > STRANGE * len(which))
        order = np.concatenate([plain, odd]).astype(np.int64)
        bounds = np.concatenate([[0], ends])[np.cumsum([0, *sizes[order]])]
        out: list = [None] * len(texts)
        for k, a, b in zip(order, bounds[:-1], bounds[1:], strict=True):
            out[k] = ids[a:b]
        return out

    def ids(self, texts):
        """Yields the ids of each text in order; texts are taken in groups of bounded size."""
        group, size = [], 0
        for text in texts:
            group.append(text or "")
            size += len(group[-1])
            if size >= BATCH_BYTES:
                yield from self._group(group)
                group, size = [], 0
        if group:
            yield from self._group(group)


_LOADED: dict[tuple[str, int | None], Encoder] = {}


def encoder(path: str, remembered: int | None = None) -> Encoder:
    """The worker's encoder for a file; later tasks of the same worker find its pieces again."""
    if (path, remembered) not in _LOADED:
        _LOADED[path, remembered] = Encoder(path, remembered)
    return _LOADED[path, remembered]
