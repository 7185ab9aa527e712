"""SentencePiece (merge type, byte fallback) encoding by backtracking, and decoding.

A sequence of pieces is the merge encoding of its text exactly if each piece is the encoding of itself and each two
neighbours are the encoding of their joined text; such a sequence is unique for every prefix. So instead of merging a
whole text, the encoder walks it: an Aho-Corasick automaton lists the pieces that begin at each position, the longest
compatible one is taken, shorter ones when it fails, and a position where none fits is marked in a bitfield and never
entered again. Compatibility is decided by merging the two pieces' text anew, once for each pair that occurs.

Texts are first cut where no piece reaches over: before spaces, and at characters that stand in no longer piece or
never follow a letter in one (both read off the vocabulary). The units repeat a lot and are kept by the worker.

Null text counts as empty: the end id alone, decoded to an empty text. Spaces and the space symbol U+2581 become the
same piece, so the latter decodes to a space, as in the library. Very long texts without a space are one unit, walked
in linear time. Repeated rows give repeated results; an empty table gives none.
"""

from __future__ import annotations

import codecs
import re
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pacecast.llm.common import Recent, map_texts, texts_of

SPACE = "▁"
MOST_UNITS, LONGEST_KEPT = 300_000, 64  # units in each of two generations


def _replace_each(error):
    return "�" * (error.end - error.start), error.end


codecs.register_error("llm-replace-each", _replace_each)


class Pieces:
    """The vocabulary of a model file; encode and decode are this module's own."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        if model.normalize("ﬁ  é x ") != f"{SPACE}ﬁ{SPACE}{SPACE}é{SPACE}x{SPACE}":
            raise ValueError("only models that keep texts as they are, behind one space, are handled")
        self.end_id = model.eos_id()
        n = model.get_piece_size()
        self.text = [model.id_to_piece(i) for i in range(n)]
        special = [model.is_control(i) or model.is_unknown(i) for i in range(n)]
        byte = [model.is_byte(i) for i in range(n)]
        normal = [i for i in range(n) if not special[i] and not byte[i]]
        self.ids = {self.text[i]: i for i in normal}
        self.score = {self.text[i]: model.get_score(i) for i in normal}
        self.length = [len(t) for t in self.text]
        self.byte_ids = [0] * 256
        for i in range(n):
            if byte[i]:
                self.byte_ids[int(self.text[i][3:5], 16)] = i
        self.surface = [t.replace(SPACE, " ").encode() for t in self.text]
        for i in range(n):
            if byte[i]:
                self.surface[i] = bytes([int(self.text[i][3:5], 16)])
            elif special[i]:
                self.surface[i] = " ⁇ ".encode() if model.is_unknown(i) else b""
        self.control = {i for i in range(n) if model.is_control(i)}
        self.led = {i for i in normal if self.text[i].startswith(SPACE)}
        if any(c not in self.ids for t in self.ids for c in t):
            raise ValueError("a piece holds a character that is no piece")
        self.automaton = ahocorasick.Automaton()
        for t, i in self.ids.items():
            self.automaton.add_word(t, i)
        self.automaton.make_automaton()
        self.unit = self._unit_pattern()
        self.fits: dict[int, bool] = {}
        self.whole: dict[int, bool] = {}
        self.kept = Recent(MOST_UNITS)  # by unit that no piece reaches over
        self.seen = Recent(MOST_UNITS)  # by part between two spaces

    def _unit_pattern(self) -> re.Pattern:
        """Units between which no piece reaches."""
        longer = [t for t in self.ids if len(t) > 1]
        if any(SPACE in t.lstrip(SPACE) for t in longer):
            return re.compile(r"(?s).+")
        inside = set("".join(longer))
        alone = "".join(re.escape(chr(c)) for c in range(128) if chr(c) not in inside)
        after_letter = {b for t in longer for a, b in zip(t, t[1:]) if a.isalpha()}
        opening = [chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) in inside - after_letter]
        opening = "".join(map(re.escape, opening))
        rest = rf"[{alone}]|{SPACE}*[^{SPACE}{alone}]+|{SPACE}+"
        return re.compile(rf"{SPACE}*[^\W\d_]+(?=[{SPACE}{alone}{opening}]|\Z)|{rest}" if alone or opening else rest)

    def merged(self, text: str) -> list[str]:
        """Merging by definition: again and again the best-scored neighbours, the leftmost of equals."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _is_whole(self, piece: int) -> bool:
        known = self.whole.get(piece)
        if known is None:
            known = self.whole[piece] = self.merged(self.text[piece]) == [self.text[piece]]
        return known

    def _fit(self, a: int, b: int) -> bool:
        known = self.fits.get(a << 32 | b)
        if known is None:
            pair = [self.text[a], self.text[b]]
            known = self.fits[a << 32 | b] = self._is_whole(b) and self.merged("".join(pair)) == pair
        return known

    def encode_unit(self, unit: str) -> list[int]:
        """Ids of a text (spaces already as symbols), by backtracking."""
        whole = self.ids.get(unit)
        if whole is not None and self._is_whole(whole):
            return [whole]
        n, length = len(unit), self.length
        starts: list[list[int]] = [[] for _ in range(n)]
        for end, piece in self.automaton.iter(unit):  # the end ascends, so each start lists shorter pieces first
            starts[end + 1 - length[piece]].append(piece)
        failed = bytearray(n + 1)
        taken: list[tuple[int, int, int]] = []  # piece, its place among its start's pieces, start
        at, last = 0, -1
        choice = len(starts[0]) - 1
        while at < n:
            options = starts[at]
            if not options:  # no piece: bytes, which nothing can merge with
                taken.append((-1, 0, at))
                at, last = at + 1, -1
                choice = len(starts[at]) - 1 if at < n else 0
                continue
            while choice >= 0:
                piece = options[choice]
                end = at + length[piece]
                if not failed[end] and (self._fit(last, piece) if last >= 0 else self._is_whole(piece)):
                    break
                choice -= 1
            if choice >= 0:
                taken.append((piece, choice, at))
                at, last = end, piece
                choice = len(starts[at]) - 1 if at < n else 0
            else:
                failed[at] = 1
                _, choice, at = taken.pop()
                last = taken[-1][0] if taken else -1
                choice -= 1
        out: list[int] = []
        for piece, _, start in taken:
            if piece >= 0:
                out.append(piece)
            else:
                out.extend(self.byte_ids[b] for b in unit[start].encode())
        return out

    def _units(self, text: str) -> list[str]:
        """Parts whose join by one space is the text, cut only at single spaces between other characters."""
        if "  " in text or SPACE in text or text[0] == " " or text[-1] == " ":
            return [text]
        return text.split(" ")

    def _learn(self, unit: str) -> bytes:
        """Ids of a part behind a space: its own units are looked up or encoded."""
        out = b""
        for u in self.unit.findall(SPACE + unit.replace(" ", SPACE)):
            for new in self.kept.missing((u,)):
                self.kept.young[new] = np.array(self.encode_unit(new), "<i4").tobytes()
            out += self.kept.young[u] if len(u) <= LONGEST_KEPT else self.kept.young.pop(u)
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text with the end id, packed as little-endian int32."""
        self.kept.turn()
        self.seen.turn()
        units = [self._units(t) if t else [] for t in texts]
        seen, once = self.seen.young, []
        for u in self.seen.missing(set(chain.from_iterable(units))):
            seen[u] = self._learn(u)
            if len(u) > LONGEST_KEPT:
                once.append(u)
        known, end = seen.__getitem__, np.array([self.end_id], "<i4").tobytes()
        out = [b"".join(map(known, u)) + end for u in units]
        for u in once:
            del seen[u]
        return out

    def decode(self, ids: list[int]) -> str:
        """The library's decode: the first piece loses its leading space, bad bytes become U+FFFD each."""
        surface, runs = self.surface, [ids]
        if not self.control.isdisjoint(ids[:-1]):  # bytes on both sides of a control id make no character together
            runs = [[]]
            for i in ids:
                if i in self.control:
                    runs.append([])
                else:
                    runs[-1].append(i)
        first, out = next((i for i in ids if i not in self.control), None), []
        for run in runs:
            text = b"".join(map(surface.__getitem__, run))
            try:
                out.append(text.decode())
            except UnicodeDecodeError:
                out.append(text.decode("utf-8", "llm-replace-each"))
        joined = "".join(out)
        return joined[1:] if first in self.led else joined


_loaded: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    """One vocabulary a Python worker and file."""
    if path not in _loaded:
        _loaded[path] = Pieces(path)
    return _loaded[path]


def encode_decode(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, ids (array of int, end id last), decoded (the text that the ids decode to)."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        vocabulary = pieces(model)
        packed = vocabulary.encode([t or "" for t in batch.column("text").to_pylist()])
        values = np.frombuffer(b"".join(packed), "<i4")
        ends = np.cumsum([len(p) // 4 for p in packed])
        offsets = np.concatenate([[0], ends]).astype(np.int32)
        decoded = [vocabulary.decode(values[s:e].tolist()) for s, e in zip(offsets, ends)]
        ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), ids, pa.array(decoded, pa.string())], names=["doc_id", "ids", "decoded"])

    return map_texts(texts_of(docs), "doc_id long, ids array<int>, decoded string", run, most=2 << 20)
