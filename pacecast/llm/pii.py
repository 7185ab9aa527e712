"""Personal data: base patterns, and a linear-chain conditional random field for what they miss.

Base spans are matched in the whole text, kind by kind (email, ip, card, phone), leftmost and non-overlapping; matches
that fail their check are dropped. The field labels the words around every word that holds a digit or an at sign
(CONTEXT words on either side, one sequence as long as such stretches touch); all other words are outside by
definition. Its features are word shapes, alone and with the neighbours' shapes; labels are B- and I- by kind. It is
trained by gradient steps on forward-backward in numpy from a small labelled table (`labelled_lines`, whose markup
`[kind:text]` gives the spans), and decoded by Viterbi over padded batches. Found spans are added where they touch no
base span; base spans always stay. `secret` is a kind of the field alone.

Null text counts as empty: no spans. Very long texts are scanned in linear time: no pattern walks a stretch twice.
Repeated rows give repeated results; an empty table gives none.
"""

from __future__ import annotations

import random
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pacecast.llm.common import map_texts, small_batches, texts_of

KINDS = ("email", "ip", "card", "phone", "secret")
CONTEXT = 2
LABELS = ("O", *(f"{b}-{k}" for k in KINDS for b in "BI"))
EPOCHS, RATE, PENALTY, SEED = 150, 0.3, 1e-3, 11

AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CANDIDATE = re.compile(r"[0-9@]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
AROUND = "\"'`.,;:!?*#$%&|<>()[]{}="


def luhn(digits: str) -> bool:
    odd, even = digits[::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as listed, then start; ends exclusive, in code points."""
    out = []
    done = 0
    for m in AT.finditer(text) if "@" in text else ():
        start = m.start()
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < m.start():
            out.append(("email", start, m.end()))
            done = m.end()
    if not CANDIDATE.search(text):
        return out
    for m in IP.finditer(text):
        parts = [p.lstrip("0") or "0" for p in m.group().split(".")]
        if all(len(p) <= 3 and int(p) <= 255 for p in parts):
            out.append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
    for m in PHONE.finditer(text) if "+" in text else ():
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


@lru_cache(maxsize=100_000)
def shape(word: str) -> str:
    """Character kinds with repeats collapsed: 9 digit, A upper, a other letters; long mixed runs are H."""
    core = word.strip(AROUND)
    if len(core) >= 16 and core.isalnum() and any(c.isdigit() for c in core) and any(c.isalpha() for c in core):
        return "H"
    out = []
    for c in core[:200]:
        s = "9" if c.isdigit() else "A" if c.isupper() else "a" if c.isalpha() else c
        if not out or out[-1] != s:
            out.append(s)
    return "".join(out[:12])


def word_features(words: list[str], i: int) -> list[str]:
    """Names of the features of word i among its sequence's words."""
    word = words[i]
    core = word.strip(AROUND)
    digits = sum(c.isdigit() for c in core)
    shapes = [shape(words[j]) if 0 <= j < len(words) else "^" for j in (i - 1, i, i + 1)]
    out = [
        "bias", f"shape={shapes[1]}", f"before={shapes[0]}", f"after={shapes[2]}", f"two={shapes[0]} {shapes[1]}",
        f"next={shapes[1]} {shapes[2]}", f"digits={min(digits, 20)}", f"length={min(len(core), 24) // 4}",
        f"open={word[:1] if not word[:1].isalnum() else 'x'}", f"first={core[:1] if not core[:1].isalnum() else 'x'}",
    ]
    if "@" in core:
        out.append("at")
    if core.count(".") == 3 and all(p.isdecimal() and int(p[:4]) <= 255 for p in core.split(".")):
        out.append("ip-valued")
    if 13 <= digits <= 19 and luhn("".join(c for c in core if c in "0123456789")):
        out.append("luhn")
    if any(words[j].lower().strip(AROUND) in SECRET_NAMES for j in range(max(0, i - 2), i)):
        out.append("named-secret")
    return out


SECRET_NAMES = frozenset("token key secret password passwd apikey api_key access_token auth".split())


def labelled_lines(n: int = 360, seed: int = SEED) -> list[str]:
    """The small labelled table: lines with `[kind:text]` around personal data, made by rule; a third hold none."""
    rng = random.Random(seed)
    letters, hexa = "abcdefghijklmnopqrstuvwxyz", "0123456789abcdef"
    word = lambda: "".join(rng.choice(letters) for _ in range(rng.randint(2, 10)))
    number = lambda k: "".join(str(rng.randint(0, 9)) for _ in range(k))

    def card():
        body = str(rng.randint(3, 6)) + number(14)
        last = next(c for c in "0123456789" if luhn(body + c))
        return rng.choice(["", " ", "-"]).join(re.findall(".{4}", body + last))

    host = lambda: f"{word()}{rng.choice(['', number(1)])}.{word()}.{rng.choice(['com', 'org', 'net'])}"
    local = lambda: f"({number(3)}) {number(3)}-{number(4)}"
    make = {
        "email": lambda: f"{word()}{rng.choice(['.', '_', ''])}{number(2)}@{host()}",
        "ip": lambda: ".".join(str(rng.randint(0, 255)) for _ in range(4)),
        "card": card,
        "phone": lambda: rng.choice([f"+1 {local()}", local(), f"+{number(2)} {number(3)} {number(3)} {number(3)}"]),
        "secret": lambda: "".join(rng.choice(hexa) for _ in range(rng.choice([32, 40, 64]))),
    }
    plain = [
        lambda: f"Version {number(1)}.{number(1)}.", lambda: f"CC BY-NC {number(1)}.{number(1)}.", lambda: f"{number(4)}",
        lambda: f"{number(4)}-{number(2)}-{number(2)}", lambda: f"{number(2)}:{number(2)}", lambda: f"${number(3)}.{number(2)}",
        lambda: f"{word()}{number(1)}", lambda: f"version {number(1)}.", lambda: f"{number(1)},{number(3)}", lambda: f"{number(16)}",
        lambda: f"@{word()}", lambda: f"{number(1)}.{number(1)}.{number(1)}", lambda: f"p. {number(2)}", lambda: f"{number(12)}",
    ]
    lines = []
    for i in range(n):
        kind = (*KINDS, None, None)[i % 7]
        if kind is None:
            middle = rng.choice(plain)()
        else:
            middle = f"[{kind}:{make[kind]()}]"
            if kind == "secret":
                middle = f'{rng.choice(["token", "key", "password", "api_key"])} {rng.choice(["=", ":"])} "{middle}"'
        noise = rng.choice(["", "", "", "***", "!!", "&&&", "###", ".", ","])
        around = [" ".join(word() + noise.strip(".,") for _ in range(rng.randint(1, 6))) for _ in range(2)]
        line = f"{around[0]}{noise} {middle}{noise} {around[1]}"
        if rng.random() < 0.15:
            line = re.sub(r"(?<!\[)\b[a-z]+\b(?![:\]])", lambda m: m.group().upper(), line)
        lines.append(line)
    return lines


def parse_line(line: str) -> tuple[str, list[tuple[str, int, int]]]:
    """(text, spans) of a labelled line."""
    text, spans, at = "", [], 0
    for m in re.finditer(rf"\[({'|'.join(KINDS)}):([^\]]*)\]", line):
        text += line[at : m.start()]
        spans.append((m[1], len(text), len(text) + len(m[2])))
        text += m[2]
        at = m.end()
    return text + line[at:], spans


def sequences(text: str) -> list[list[tuple[int, int]]]:
    """Word places (start, end) of the stretches the field looks at."""
    if not CANDIDATE.search(text):
        return []
    places = [m.span() for m in WORD.finditer(text)]
    out: list[list[int]] = []
    for i, (s, e) in enumerate(places):
        if CANDIDATE.search(text, s, e):
            first = max(0, i - CONTEXT)
            last = min(len(places), i + CONTEXT + 1)
            if out and first <= out[-1][-1] + 1:
                out[-1].extend(range(out[-1][-1] + 1, last))
            else:
                out.append(list(range(first, last)))
    return [[places[i] for i in run] for run in out]


class Field:
    """Weights of the linear chain; decode gives the best labels of many sequences at once."""

    def __init__(self, names: dict[str, int]):
        self.names = names
        self.emit = np.zeros((len(names), len(LABELS)))
        self.step = np.zeros((len(LABELS), len(LABELS)))
        # I- follows its own kind alone; a sequence doesn't begin inside.
        kind = [lab[2:] for lab in LABELS]
        self.allowed = np.array([[b[0] != "I" or kind[i] == kind[j] for j, b in enumerate(LABELS)] for i in range(len(LABELS))])
        self.begin = np.array([0.0 if lab[0] != "I" else -1e4 for lab in LABELS])

    def emissions(self, rows: list[list[list[str]]]) -> tuple[np.ndarray, np.ndarray]:
        """(scores padded to sequence, place, label; lengths)."""
        lengths = np.array([len(r) for r in rows])
        out = np.zeros((len(rows), lengths.max(initial=1), len(LABELS)))
        for i, row in enumerate(rows):
            for t, features in enumerate(row):
                known = [self.names[f] for f in features if f in self.names]
                out[i, t] = self.emit[known].sum(0)
        return out, lengths

    def transitions(self) -> np.ndarray:
        return np.where(self.allowed, self.step, -1e4)

    def decode(self, rows: list[list[list[str]]]) -> list[np.ndarray]:
        """Viterbi over a padded batch."""
        if not rows:
            return []
        scores, lengths = self.emissions(rows)
        step = self.transitions()
        best = scores[:, 0] + self.begin
        back = np.zeros(scores.shape, np.int16)
        for t in range(1, scores.shape[1]):
            through = best[:, :, None] + step
            back[:, t] = through.argmax(1)
            alive = (t < lengths)[:, None]
            best = np.where(alive, through.max(1) + scores[:, t], best)
        out, last, row = np.zeros(scores.shape[:2], np.int16), best.argmax(1), np.arange(len(rows))
        for t in range(scores.shape[1] - 1, -1, -1):
            inside = t < lengths
            out[inside, t] = last[inside]
            last = np.where(inside & (t > 0), back[row, t, last], last)
        return [o[:n] for o, n in zip(out, lengths)]

    def fit(self, rows: list[list[list[str]]], labels: list[list[int]]) -> None:
        """Penalised likelihood by full-batch adaptive steps; gradients by forward-backward."""
        lengths = np.array([len(r) for r in rows])
        n, width, k = len(rows), lengths.max(), len(LABELS)
        ids = [[[self.names[f] for f in fs] for fs in row] for row in rows]
        flat = np.array([(i, t, f) for i, row in enumerate(ids) for t, fs in enumerate(row) for f in fs])
        where, feature = flat[:, 0] * width + flat[:, 1], flat[:, 2]
        gold = np.zeros((n, width, k))
        pairs = np.zeros((k, k))
        for i, own in enumerate(labels):
            gold[i, np.arange(len(own)), own] = 1
            np.add.at(pairs, (own[:-1], own[1:]), 1)
        inside = np.arange(width) < lengths[:, None]
        squares = [np.full_like(self.emit, 1e-6), np.full_like(self.step, 1e-6)]
        for _ in range(EPOCHS):
            scores = np.zeros((n * width, k))
            np.add.at(scores, where, self.emit[feature])
            scores = scores.reshape(n, width, k)
            step = self.transitions()
            forward, backward = np.zeros((n, width, k)), np.zeros((n, width, k))
            forward[:, 0] = scores[:, 0] + self.begin
            for t in range(1, width):
                x = forward[:, t - 1, :, None] + step
                top = x.max(1)
                new = top + np.log(np.exp(x - top[:, None]).sum(1)) + scores[:, t]
                forward[:, t] = np.where(inside[:, t, None], new, forward[:, t - 1])
            for t in range(width - 2, -1, -1):
                x = step + (scores[:, t + 1] + backward[:, t + 1])[:, None, :]
                top = x.max(2)
                new = top + np.log(np.exp(x - top[..., None]).sum(2))
                backward[:, t] = np.where(inside[:, t + 1, None], new, 0.0)
            top = forward[:, -1].max(1)
            total = top + np.log(np.exp(forward[:, -1] - top[:, None]).sum(1))
            marginal = np.exp(forward + backward - total[:, None, None]) * inside[..., None]
            moves = np.zeros((k, k))
            for t in range(1, width):
                x = forward[:, t - 1, :, None] + step + (scores[:, t] + backward[:, t])[:, None, :] - total[:, None, None]
                moves += (np.exp(x) * inside[:, t, None, None]).sum(0)
            d_emit = np.zeros_like(self.emit)
            np.add.at(d_emit, feature, (gold - marginal).reshape(n * width, k)[where])
            for weights, gradient, square in ((self.emit, d_emit, squares[0]), (self.step, pairs - moves, squares[1])):
                gradient = gradient / n - PENALTY * weights
                square += gradient**2
                weights += RATE * gradient / np.sqrt(square)


def _labels(text: str, spans: list[tuple[str, int, int]], places: list[tuple[int, int]]) -> list[int]:
    out, before = [], None
    for s, e in places:
        met = next((sp for sp in spans if s < sp[2] and sp[1] < e), None)
        out.append(0 if met is None else LABELS.index(f"{'I' if met == before else 'B'}-{met[0]}"))
        before = met
    return out


def train(lines: list[str] | None = None) -> Field:
    """Fit the field to labelled lines; small enough for the driver."""
    rows, labels = [], []
    for line in labelled_lines() if lines is None else lines:
        text, spans = parse_line(line)
        for places in sequences(text):
            words = [text[s:e] for s, e in places]
            rows.append([word_features(words, i) for i in range(len(words))])
            labels.append(_labels(text, spans, places))
    names: dict[str, int] = {}
    for row in rows:
        for features in row:
            for f in features:
                names.setdefault(f, len(names))
    field = Field(names)
    if rows:
        field.fit(rows, labels)
    return field


def field_spans(texts: list[str], field: Field, block: int = 512) -> list[list[tuple[str, int, int]]]:
    """Spans that the field marks in each text."""
    where = [(i, places) for i, text in enumerate(texts) for places in sequences(text)]
    where.sort(key=lambda x: len(x[1]))  # batches of like length need little padding
    out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    at = 0
    while at < len(where):
        part = where[at : at + max(1, min(block, 200_000 // len(where[min(at + block, len(where)) - 1][1])))]
        at += len(part)
        rows = []
        for i, places in part:
            words = [texts[i][s:e] for s, e in places]
            rows.append([word_features(words, j) for j in range(len(words))])
        for (i, places), labels in zip(part, field.decode(rows)):
            begun = None
            for (s, e), label in zip([*places, (0, 0)], [*labels, 0]):
                name = LABELS[label]
                if name[0] == "I" and begun:
                    begun[2] = e
                    continue
                if begun:
                    out[i].append(_trimmed(texts[i], *begun))
                begun = [name[2:], s, e] if name[0] == "B" else None
    return [sorted(x for x in found if x[1] < x[2]) for found in out]


def _trimmed(text: str, kind: str, start: int, end: int) -> tuple[str, int, int]:
    """A span without the marks around it (a phone keeps its opening bracket)."""
    around = AROUND.replace("(", "") if kind == "phone" else AROUND
    while start < end and text[start] in around:
        start += 1
    while end > start and text[end - 1] in AROUND:
        end -= 1
    return kind, start, end


def all_spans(texts: list[str], field: Field) -> list[tuple[list, list]]:
    """(base spans, base and added spans) of each text, by kind as listed, then start."""
    out = []
    for text, found in zip(texts, field_spans(texts, field)):
        base = base_spans(text)
        taken = sorted((s, e) for _, s, e in base)
        added = []
        for kind, s, e in found:
            if all(e <= a or b <= s for a, b in taken):
                added.append((kind, s, e))
        out.append((base, sorted(base + added, key=lambda x: (KINDS.index(x[0]), x[1]))))
    return out


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def find(docs: DataFrame, field: Field) -> DataFrame:
    """doc_id, base (base spans joined), spans (all joined) of every row: kind:start:end, comma between."""
    sent = docs.sparkSession.sparkContext.broadcast(field)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = all_spans([t or "" for t in batch.column("text").to_pylist()], sent.value)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([joined(b) for b, _ in found]), pa.array([joined(s) for _, s in found])],
            names=["doc_id", "base", "spans"],
        )

    return map_texts(texts_of(docs), "doc_id long, base string, spans string", run)


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span (overlapping ones together) replaced by its kind in capitals between < and >."""
    out, at = [], 0
    for s, e, kind in sorted((s, e, k) for k, s, e in spans):
        if s >= at:
            out += [text[at:s], f"<{kind.upper()}>"]
        at = max(at, e)
    return "".join(out) + text[at:]


def redacted(docs: DataFrame, field: Field) -> DataFrame:
    """All rows and columns, personal data in text replaced by its kind; n_chars, if there, follows a changed text."""
    sent = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches):
        for batch in small_batches(batches):
            texts = batch.column("text").to_pylist()
            found = all_spans([t or "" for t in texts], sent.value)
            after = [redact(t, spans) if spans else t for t, (_, spans) in zip(texts, found)]
            at = batch.schema.get_field_index("text")
            batch = batch.set_column(at, batch.schema.field(at), pa.array(after, batch.schema.field(at).type))
            at = batch.schema.get_field_index("n_chars")
            if at >= 0 and pa.types.is_integer(batch.schema.field(at).type):
                old = batch.column(at).to_pylist()
                size = [len(a) if spans else n for a, n, (_, spans) in zip(after, old, found)]
                batch = batch.set_column(at, batch.schema.field(at), pa.array(size, batch.schema.field(at).type))
            yield batch

    return docs.mapInArrow(run, docs.schema)
