"""Token ids of whole texts, piece by piece.

The ``tokenizers`` library cuts a text into pre-tokens before it merges anything, so a text may be
split wherever a pre-token surely ends: at a single space or line break between two characters that
are not white space. The pieces repeat a great deal; a batch's are taken once each. Those of plain letters
are parted from the punctuation behind them and, where the file lower-cases, lower-cased all at once;
every word is then encoded once by the library and looked up afterwards. A text is never cut elsewhere,
and a special token, which has no white space, stays inside one piece and is treated as the library
treats it.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from shelfline.llm.common import at_end, worker_cache

#: Words remembered within a task; then it starts anew. Bounds memory, changes no result.
REMEMBERED = 800_000
#: Bytes of text in a batch.
BATCH_BYTES = 8 << 20

_SPACE = r"[\s\x0b\x1c-\x1f\x{85}\x{180e}\pZ]"
#: Texts in which a single space or line break need not be a boundary. U+180E was white space once.
_ODD = rf"{_SPACE}{{2}}|^{_SPACE}|{_SPACE}$|\x{{180e}}|\x00"
_BOUNDARY = re.compile(r"(?<=[^\s\u180e])(?= [^\s\u180e])|(?<=[^\s\u180e])(?=\n[^\s\u180e])|(?<=[^\s\u180e]\n)(?=[^\s\u180e])")
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_MARKS = ".,;:!?%&*$#()"
#: Pieces that are one pre-token, or one and another of marks.
_PLAIN = rf"^ ?[{_LETTERS}]+[{_MARKS}]*$"
_SPACE_AND_LETTERS = " " + "".join(re.findall(f"[{_LETTERS}]", "".join(map(chr, range(256)))))


def _byte_characters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies: printable
    Latin-1 stands for itself, the others follow from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(0x100 + i) for i, b in enumerate(others)}


def _joined(ids: np.ndarray, begin: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches of ``ids`` one after the other, and where each of them begins, with the end of all."""
    # All count ids of one batch or of the remembered words: four bytes are enough.
    upto = np.zeros(len(lens) + 1, np.int32)
    np.cumsum(lens, out=upto[1:])
    places = np.repeat((begin - upto[:-1]).astype(np.int32, copy=False), lens)
    places += np.arange(len(places), dtype=np.int32)
    return ids[places], upto


class Encoder:
    """Ids of a ``tokenizers`` file, without added special tokens, truncation or padding."""

    def __init__(self, path: str, remembered: int | None = None):
        from tokenizers import Tokenizer

        self.remembered = remembered or REMEMBERED

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        before = spec.get("pre_tokenizer") or {}
        steps = before.get("pretokenizers", [before])
        normal = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        self.lower = "Lowercase" in normal
        byte_level = steps[-1].get("type") == "ByteLevel" and not steps[-1].get("add_prefix_space")
        kept_space = byte_level and len(steps) == 1 and steps[0].get("use_regex") and spec.get("normalizer") is None
        dropped_space = byte_level and [s.get("type") for s in steps] == ["Split", "ByteLevel"] and normal == ["NFC", "Replace", "Lowercase"]
        flags = [t.get(k) for t in spec.get("added_tokens", []) for k in ("lstrip", "rstrip", "single_word", "normalized")]
        #: Whether a piece keeps the space before it, or None where texts may not be split.
        self.kept_space = None if any(flags) or not (kept_space or dropped_space) else bool(kept_space)
        self.chars = {ord(bytes([b]).decode("latin1")): c for b, c in _byte_characters().items()}
        self._forget()

    def _forget(self) -> None:
        # Word to code. The ids of code ``c`` are ``ids[starts[c]:starts[c + 1]]``; code 0 has none.
        self.codes, self.ids, self.starts = {"": 0}, array("I"), array("q", [0, 0])

    def _library(self, piece: str) -> list[int]:
        return self.tokenizer.encode(piece, add_special_tokens=False).ids

    def _merge(self, word: str) -> list[int]:
        """Ids of one normalized pre-token: straight to the merges."""
        if not word.isascii():
            word = word.encode().decode("latin1").translate(self.chars)
        elif word[0] == " ":  # ASCII letters stand for themselves
            word = self.chars[32] + word[1:]
        return [t.id for t in self.model.tokenize(word)]

    def _coded(self, words: pa.Array, encode: Callable[[str], list[int]]) -> np.ndarray:
        """The code of every word; unknown ones are encoded first."""
        coded = words.dictionary_encode()
        each = coded.dictionary.to_numpy(zero_copy_only=False)
        for word in each:
            if word not in self.codes:
                found = encode(word)
                self.codes[word] = len(self.starts) - 1
                self.ids.extend(found)
                self.starts.append(len(self.ids))
        return np.fromiter(map(self.codes.__getitem__, each), np.int64, len(each))[coded.indices.to_numpy()]

    def _parts(self, pieces: pa.Array) -> np.ndarray:
        """For every piece the codes of the word and of the marks behind it. Other pieces are words."""
        codes = np.zeros((len(pieces), 2), np.int64)
        is_plain = pc.match_substring_regex(pieces, _PLAIN)
        plain, at = pieces.filter(is_plain), is_plain.to_numpy(zero_copy_only=False)
        words = pc.utf8_rtrim(plain, _MARKS)
        codes[at, 0] = self._coded(pc.utf8_lower(words) if self.lower else words, self._merge)
        codes[at, 1] = self._coded(pc.utf8_ltrim(plain, _SPACE_AND_LETTERS), self._library)
        codes[~at, 0] = self._coded(pieces.filter(pc.invert(is_plain)), self._library)
        return codes

    def _split(self, texts: pa.Array) -> pa.ListArray:
        """The pieces of every text."""
        if self.kept_space is None:
            marked = texts
        elif not self.kept_space:
            marked = pc.replace_substring(pc.replace_substring(texts, "\n", "\0"), " ", "\0")
        else:
            marked = pc.replace_substring(pc.replace_substring(texts, " ", "\0 "), "\n", "\0\n\0")
            odd = pc.match_substring_regex(texts, _ODD)
            if pc.any(odd).as_py():
                cut = ["\0".join(_BOUNDARY.split(t)) for t in texts.filter(odd).to_pylist()]
                marked = pc.replace_with_mask(marked, odd, pa.array(cut, texts.type))
        return pc.split_pattern(marked, "\0")

    def _looked_up(self, texts: pa.Array):
        """For every distinct piece where its parts' ids begin and how many they are; the pieces of all
        texts as places among those; for every text its first piece."""
        if len(self.codes) > self.remembered:
            self._forget()
        pieces = self._split(texts)
        coded, first = pieces.values.dictionary_encode(), pieces.offsets.to_numpy()
        del pieces  # not held while words are encoded
        codes, starts = self._parts(coded.dictionary), np.frombuffer(self.starts, np.int64)
        return starts[codes], starts[codes + 1] - starts[codes], coded.indices.to_numpy(), first

    def _whole(self, texts: pa.Array) -> bool:
        """Whether the texts go to the library uncut: they hold the mark used for cutting."""
        return pc.any(pc.match_substring(texts, "\0")).as_py() or False

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, as unsigned 32-bit integers, and where each
        text ends. A null text has none."""
        texts = texts.fill_null("")
        if self._whole(texts):
            each = [self._library(t) for t in texts.to_pylist()]
            return np.array([i for ids in each for i in ids], np.uint32), np.cumsum([len(ids) for ids in each], dtype=np.int64)
        begin, lens, places, first = self._looked_up(texts)
        ids, upto = _joined(np.frombuffer(self.ids, np.uint32), begin.ravel(), lens.ravel())
        ids, upto = _joined(ids, upto[:-1:2][places], lens.sum(axis=1, dtype=np.int32)[places])
        return ids, upto[first[1:]].astype(np.int64)

    def count(self, texts: pa.Array) -> np.ndarray:
        """How many ids each text has."""
        texts = texts.fill_null("")
        if self._whole(texts):
            return np.array([len(self._library(t)) for t in texts.to_pylist()], np.int64)
        _, lens, places, first = self._looked_up(texts)
        return np.diff(np.concatenate([[0], np.cumsum(lens.sum(axis=1)[places])])[first])


def encoder(path: str, remembered: int | None = None) -> Encoder:
    """The worker's encoder of a file. What it remembers goes when the task ends."""
    held = worker_cache()
    if ("encoder", path) not in held:
        held["encoder", path] = Encoder(path)
    held["encoder", path].remembered = remembered or REMEMBERED
    at_end(held["encoder", path]._forget)
    return held["encoder", path]
