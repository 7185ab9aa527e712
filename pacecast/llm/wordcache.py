"""Byte-level BPE with the tokenizers library, a text's space-separated units encoded once a worker.

The pre-tokeniser never lets a token reach over a single space between two visible characters (such a space starts the
next pre-token), nor over a single line end between two (which is a pre-token of its own). So a text can be cut before
either, each unit encoded alone, and the ids joined, with the same result as for the whole text. Units repeat a lot; the
library sees each about once.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np

from pacecast.llm.common import Recent

# A cut is safe between characters that no Unicode version counts as white space; leaving a cut out is always safe.
SAFE_CUT = re.compile(r"(?<=[!-~\w]) (?=[!-~\w])")
OTHER_SPACES = "\t\n\r\x0b\x0c\x1c\x1d\x1e\x1f"
# Letters, then marks: two pre-tokens whatever stands around them.
WORD = re.compile("\\n?([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([.,;:!?]*)")
RARE_SPACE = re.compile("[^!-~\\w \t\n\r\x0b\x0c]")


class WordCache:
    """encode(texts) gives each text's ids as packed little-endian integers of `dtype`."""

    MOST_UNITS = 300_000  # in each of two generations
    MOST_HEADS = 30_000
    LONGEST_UNIT = 64
    CHUNK = 5_000

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        self.byte_length = np.zeros(size, np.int64)
        for token, at in self.tokenizer.get_vocab(with_added_tokens=True).items():
            self.byte_length[at] = len(token)
        self.later = Recent(self.MOST_UNITS)
        self.split = self._split_tokenizer()
        self.first = Recent(self.MOST_HEADS)

    def _split_tokenizer(self):
        """The same model behind pre-tokens that stand apart already; None where words cannot be told in advance.

        The library spends most of a unit's time on finding its pre-tokens.
        """
        from tokenizers import Tokenizer, pre_tokenizers

        found = self.tokenizer.pre_tokenizer
        by_bytes = isinstance(found, pre_tokenizers.ByteLevel) and found.use_regex and not found.add_prefix_space
        if not by_bytes or self.tokenizer.normalizer is not None:
            return None
        spell = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.byte_marks = {c: spell.pre_tokenize_str(chr(c))[0][0] for c in [10, 32, *range(0xC0, 0x100)]}
        split = Tokenizer(self.tokenizer.model)
        split.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        return split

    def units(self, text: str) -> list[str]:
        """The text's parts: the first begins it, each other follows a space or, if it starts with a line end, nothing."""
        held = [c for c in OTHER_SPACES if c in text]
        apart = not any(c + " " in text or " " + c in text for c in " " + "".join(held))
        if not (apart and text[:1] != " " and text[-1:] != " " and (text.isascii() or not RARE_SPACE.search(text))):
            return SAFE_CUT.split(text)
        if held == ["\n"] and "\n\n" not in text and text[0] != "\n" and text[-1] != "\n":
            text = text.replace("\n", " \n")
        return text.split(" ")

    @staticmethod
    def _spelled(unit: str) -> str:
        """The characters that a unit after the first stands for."""
        return unit if unit[:1] == "\n" else " " + unit

    def _packed(self, strings: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(strings, add_special_tokens=False)
        return [np.array(x.ids, self.dtype).tobytes() for x in found]

    def _learn(self, units: list[str]) -> None:
        """Encode units after the first; words whose pre-tokens are known go to the model without a search for them."""
        if self.split is None:
            return self._learn_spelled(self.tokenizer, units, list(map(self._spelled, units)))
        words, spelled, rest = [], [], []
        space, line = self.byte_marks[32], self.byte_marks[10] + " "
        for unit in units:
            found = WORD.fullmatch(unit)
            if found is None:
                rest.append(unit)
                continue
            word, marks = found.groups()
            word = word if unit.isascii() else word.translate(self.byte_marks)
            words.append(unit)
            spelled.append(f"{line if unit[0] == chr(10) else space}{word} {marks} ")
        self._learn_spelled(self.split, words, spelled)
        self._learn_spelled(self.tokenizer, rest, list(map(self._spelled, rest)))

    def _learn_spelled(self, tokenizer, units: list[str], spelled: list[str]) -> None:
        """Many units in one string, the ids cut at the units' byte ends."""
        known, width = self.later.young, self.dtype.itemsize
        for at in range(0, len(units), self.CHUNK):
            chunk, text = units[at : at + self.CHUNK], spelled[at : at + self.CHUNK]
            ids = tokenizer.encode_batch_fast(["".join(text)], add_special_tokens=False)[0].ids
            ids = np.array(ids, self.dtype)
            ends = np.cumsum(self.byte_length[ids])
            unit_ends = np.cumsum([len(self._spelled(u).encode()) for u in chunk])
            cut = np.searchsorted(ends, unit_ends) + 1
            if cut[-1] > len(ids) or not np.array_equal(ends[cut - 1], unit_ends):  # tokens over spaces
                known.update(zip(chunk, self._packed([self._spelled(u) for u in chunk])))
                continue
            packed = ids.tobytes()
            starts = [0, *(cut[:-1] * width).tolist()]
            known.update(zip(chunk, [packed[s:e] for s, e in zip(starts, (cut * width).tolist())]))

    def encode(self, texts: list[str]) -> list[bytes]:
        self.later.turn()
        self.first.turn()
        parts = [self.units(t) for t in texts]
        heads = [p.pop(0) for p in parts]
        unknown = self.first.missing(dict.fromkeys(heads))
        self.first.young.update(zip(unknown, self._packed(unknown)))
        need = self.later.missing(set(chain.from_iterable(parts)))
        long = [u for u in need if len(u) > self.LONGEST_UNIT]
        self._learn([u for u in need if len(u) <= self.LONGEST_UNIT])
        known, first = self.later.young, self.first.young
        known.update(zip(long, self._packed([self._spelled(u) for u in long])))
        ids_of = known.__getitem__
        out = [first[h] + b"".join(map(ids_of, p)) for h, p in zip(heads, parts)]
        for u in long:
            del known[u]
        for h in unknown:
            if len(h) > self.LONGEST_UNIT:
                del first[h]
        return out


_caches: dict[str, WordCache] = {}


def word_cache(path: str) -> WordCache:
    """One cache a Python worker and tokenizer file."""
    if path not in _caches:
        _caches[path] = WordCache(path)
    return _caches[path]
