"""N-gram Jaccard join, spelling variants and importance resampling against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from pacecast.llm import importance, jaccard, variants

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(row):
    return tuple((v is not None, v) for v in row)


def same(got, want):
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def joined_brute(rows, size, percent):
    """(doc_id, n_shingles, component_id, n_copies) of (doc_id, text) rows, all pairs compared."""
    sets = []
    for _, text in rows:
        w = (text or "").translate(LOWER).encode().split()
        whole = {tuple(w)} if w else set()
        sets.append(frozenset(zip(*(w[i:] for i in range(size)))) if len(w) >= size else frozenset(whole))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    ids = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        ids[find(i)].append(doc_id)
    least = {r: min((i for i in found if i is not None), default=None) for r, found in ids.items()}
    copies = Counter(sets)
    return [(d, len(s), least[find(i)], copies[s] if s else 1) for i, ((d, _), s) in enumerate(zip(rows, sets))]


@pytest.mark.parametrize("percent", [60, 90, 100])
def test_jaccard_join(docs, doc_rows, percent):
    rows = [(r[0], r[1]) for r in doc_rows]
    same(jaccard.similar(docs, percent=percent).collect(), joined_brute(rows, 3, percent))


def test_jaccard_join_of_nothing(none):
    assert jaccard.similar(none).collect() == []


def clumps(seed, clump=60, words=60, vocabulary=400):
    """Texts that share much: clumps whose members differ by single words, of a few lengths, and one common passage."""
    rng = random.Random(seed)
    word = lambda: f"w{int(rng.random() ** 2 * vocabulary)}"
    common, out = [word() for _ in range(20)], []
    for _ in range(4):
        base = [word() for _ in range(words)]
        for _ in range(clump):
            text = list(base)
            for _ in range(rng.randrange(4)):
                text[rng.randrange(len(text))] = word()
            out.append(text[: rng.randrange(words - 6, words + 1)])
    out += [[word() for _ in range(rng.randrange(1, 15))] + common for _ in range(clump)]
    out += [[word() for _ in range(rng.randrange(5))] for _ in range(clump)]
    return [(i, " ".join(t)) for i, t in enumerate(out)]


@pytest.mark.parametrize("seed,size,percent", [(1, 3, 90), (2, 1, 80), (3, 2, 60), (4, 1, 95)])
def test_jaccard_join_of_clumps(spark, seed, size, percent):
    rows = clumps(seed)
    got = jaccard.similar(spark.createDataFrame(rows, "doc_id long, text string"), size, percent)
    same(got.collect(), joined_brute(rows, size, percent))


def test_jaccard_prefix_groups_of_several_classes(spark):
    """Groups of one prefix and size whose members are not all within reach of the first one."""
    rng = random.Random(9)
    rows = []
    for i in range(40):
        rest = [f"r{(i % 4) * 10 + rng.randrange(12)}" for _ in range(8)]
        rows.append((i, " ".join(["rare1", "rare2", *rest])))
    rows += [(100 + i, " ".join(rng.choice([f"r{k}" for k in range(50)]) for _ in range(60))) for i in range(50)]
    got = jaccard.similar(spark.createDataFrame(rows, "doc_id long, text string"), 1, 75)
    same(got.collect(), joined_brute(rows, 1, 75))


def test_long_text_is_hashed_in_slices():
    words = [f"word{i % 5000}" for i in range(400_000)]
    text = " ".join(words).encode()
    hashes = jaccard.WordHashes()
    want = {tuple(words[i : i + 3]) for i in range(len(words) - 2)}
    assert len(list(jaccard.slices(text, 1000))) > 1000
    assert len(jaccard.shingle_set(text, 3, hashes)) == len(want)
    assert b" ".join(jaccard.slices(text, 1000)) == text


def variants_brute(rows, slip_of, shortest, least, times):
    counts = Counter()
    for doc_id, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = w.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if h % slip_of == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            counts[w] += 1
    words = {w: n for w, n in counts.items() if len(w) >= shortest and n >= least}

    def near(a, b):
        if a == b or abs(len(a) - len(b)) > 1:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    form, n_near = {}, Counter()
    for w in words:
        found = [x for x in words if near(w, x)]
        n_near[w] = len(found)
        best = min(found, key=lambda x: (-words[x], x), default=None)
        if best and words[best] >= times * words[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return [(w, form.get(w), root(w), n, n_near[w], words.get(form.get(w))) for w, n in words.items()]


@pytest.mark.parametrize("slip_of,shortest,least", [(97, 5, 3), (3, 3, 1), (5, 1, 2)])
def test_spelling_variants(docs, doc_rows, slip_of, shortest, least):
    rows = [(r[0], r[1]) for r in doc_rows]
    got = variants.spelling_variants(docs, slip_of, shortest, least)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    same(got.collect(), variants_brute(rows, slip_of, shortest, least, 2))


@pytest.mark.parametrize("letters,longest", [("ab", 7), ("aé÷", 5), ("abcdefgh", 4)])
def test_spelling_variants_of_dense_words(spark, letters, longest):
    """Few letters, so that words have many near words, ties and long chains of forms."""
    rng = random.Random(longest)
    rows = []
    for i in range(30):
        words = ["".join(rng.choice(letters) for _ in range(rng.randint(1, longest))) for _ in range(60)]
        rows.append((i, rng.choice([" ", "Ā", "中", "-1 "]).join(words)))
    rows += [(99, "abab " * 2), (98, "ababa " * 5), (97, "ababab " * 11), (96, "abababa " * 23), (None, "abababab " * 47)]
    got = variants.spelling_variants(spark.createDataFrame(rows, "doc_id long, text string"), 10**9, 1, 1)
    same(got.collect(), variants_brute(rows, 10**9, 1, 1, 2))


def test_spelling_variants_of_nothing(none):
    assert variants.spelling_variants(none).collect() == []


def test_runs_cut_long_texts(monkeypatch):
    text = "Ünï-x " * 5000 + "y" * 3000
    want = [w.translate(LOWER) for w in re.findall("[A-Za-zÀ-ÿ]+", text)]
    monkeypatch.setattr(variants, "SLICE_CHARS", 100)
    pieces = list(variants.runs(text))
    assert len(pieces) > 100 and [w.decode("latin-1") for p in pieces for w in p] == want


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def resampled_brute(rows, target, longest, buckets, percent, least):
    def of(text):
        w = WORD.findall((text or "").translate(LOWER))
        runs = [" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]
        return len(w), [zlib.crc32(r.encode()) % buckets for r in runs]

    found = [of(t) for _, t in rows]
    raw, wanted = Counter(b for _, f in found for b in f), Counter(b for t in target for b in of(t)[1])
    s, t = sum(raw.values()), sum(wanted.values())
    gain = [math.floor(1000 * math.log((wanted[b] + 1) * (s + buckets) / ((raw[b] + 1) * (t + buckets)))) for b in range(buckets)]
    out, able = [], []
    for (doc_id, _), (n, f) in zip(rows, found):
        name = "2024:" + ("" if doc_id is None else str(doc_id))
        h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        out.append([doc_id, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
        able += [out[-1]] if n >= least else []
    able.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(able[: percent * len(able) // 100]):
        r[4] = k + 1
    return [tuple(r) for r in out]


@pytest.mark.parametrize("longest,buckets,percent,least", [(1, 10_000, 10, 20), (3, 97, 60, 2), (2, 1, 100, 0)])
def test_importance_resampling(docs, doc_rows, benchmark, longest, buckets, percent, least):
    rows = [(r[0], r[1]) for r in doc_rows]
    target = [r["text"] for r in benchmark.collect()]
    got = importance.resample(docs, benchmark, longest, buckets, percent, least, rank_rows=7)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    want = resampled_brute(rows, target, longest, buckets, percent, least)
    # Rows of one doc_id and score are one another's tie: either may have the better rank.
    same([r[:4] for r in map(tuple, got.collect())], [r[:4] for r in want])
    ranked = lambda rows: sorted((r[4], r[0], r[2], r[3]) for r in rows if r[4] is not None)
    ties = lambda rows: [(k, s) for k, _, _, s in ranked(rows)]
    assert ties([(*r[:4], r[4]) for r in map(tuple, got.collect())]) == ties(want)


def test_ranks_of_tied_rows_are_gapless(spark):
    rows = spark.range(5000).selectExpr("id as row", "cast(null as long) as doc_id", "cast(id % 3 as long) as score")
    got = [tuple(r) for r in importance.ranked(rows, 2000, rank_rows=100).orderBy("rank").collect()]
    assert [r[1] for r in got] == list(range(1, 2001))
    assert [r[0] for r in got[:1666]] == list(range(2, 5000, 3))
    assert importance.ranked(rows, 0).collect() == []


def test_importance_of_nothing(none, docs, benchmark):
    assert importance.resample(none, benchmark).collect() == []
    held = importance.resample(docs, none).collect()
    assert len(held) == docs.count() and any(r["rank"] for r in held)


def test_split_equals_pattern_and_cuts_long_texts(monkeypatch):
    rng = random.Random(3)
    letters = list("abZ09_é中😀 \t\n\x00\x7f-'") + [" ", "  "]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(400))) for _ in range(200)]
    monkeypatch.setattr(importance, "SLICE_BYTES", 50)
    maker = importance.Features(1, 100)
    for t in texts:
        assert list(maker.words(t.encode())) == WORD.findall(t.translate(LOWER))
