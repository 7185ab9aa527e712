"""Caches that overflow, very long texts, and languages with hardly any text."""

import tracemalloc

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from pacecast.llm import langid, simhash, sptok, wordcache
from pacecast.llm.common import Recent
from pacecast.llm.queries import BYTE_BPE, PIECES


def test_recent_keeps_what_is_met():
    held, learnt = Recent(10), []
    for turn in range(200):
        held.turn()
        for key in held.missing(["hot", f"new {turn}"]):
            learnt.append(key)
            held.young[key] = len(key)
        assert held.young["hot"] == 3 and len(held.young) + len(held.old) <= 24
    assert learnt.count("hot") == 1 and len(learnt) == 201


def texts(n, seed):
    rng = np.random.default_rng(seed)
    return [" ".join(f"word{x}é" for x in rng.zipf(1.3, 60) % 5000) for _ in range(n)]


def test_word_cache_that_overflows(monkeypatch):
    monkeypatch.setattr(wordcache.WordCache, "MOST_UNITS", 50)
    monkeypatch.setattr(wordcache.WordCache, "MOST_HEADS", 5)
    cache = wordcache.WordCache(public_tokenizers.path(BYTE_BPE))
    for seed in range(20):
        batch = texts(10, seed)
        want = cache.tokenizer.encode_batch(batch, add_special_tokens=False)
        assert [np.frombuffer(p, cache.dtype).tolist() for p in cache.encode(batch)] == [e.ids for e in want]
        assert len(cache.later.old) <= 50 + 600


def test_pieces_that_overflow(monkeypatch):
    monkeypatch.setattr(sptok, "MOST_UNITS", 50)
    small = sptok.Pieces(public_tokenizers.path(PIECES))
    monkeypatch.setattr(sptok, "MOST_UNITS", 100_000)
    large = sptok.Pieces(public_tokenizers.path(PIECES))
    for seed in range(10):
        batch = [*texts(10, seed), "x" * 100 + " y", ""]
        assert small.encode(batch) == large.encode(batch)
        assert max(map(len, small.kept.young)) <= sptok.LONGEST_KEPT


def plain_fingerprint(text, size):
    w = text.lower().split()
    shingles = [b" ".join(w[i : i + size]) for i in range(max(len(w) - size + 1, 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("size", [1, 3])
def test_fingerprints_in_slices_and_blocks(monkeypatch, size):
    monkeypatch.setattr(simhash, "SLICE_BYTES", 40)
    monkeypatch.setattr(simhash, "BLOCK", 7)
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 4, 50, 400):
        text = b" \n".join(b"W%d" % x for x in rng.integers(0, 900, n))
        assert simhash.fingerprint(text, size) == plain_fingerprint(text, size)


def test_fingerprint_of_a_long_text_needs_little_memory():
    text = b" ".join(b"word%d" % (i % 70_000) for i in range(800_000))
    tracemalloc.start()
    simhash.fingerprint(text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(text) > 7_000_000 and peak < 20_000_000


def test_languages_of_one_text_have_trees(spark):
    rows = [(i, f"{chr(97 + i % 26) * 3}{chr(97 + i // 26)} {chr(0x400 + i)} text", f"l{i:02}") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    trees = langid.train(docs, F.lit(True))
    assert len(trees.languages) == 50
    assert all((level["kinds"].sum(0) > 0).all() for level in trees.levels[1:])
    got = {r["doc_id"]: r for r in langid.predict(docs, trees).collect()}
    assert all(got[i]["lang_pred"] == lang for i, _, lang in rows)


def test_a_poor_language_does_not_win_what_it_never_saw(spark):
    rows = [(i, "the quick brown fox jumps over the lazy dog and runs away " * 20, "en") for i in range(3)]
    rows += [(9, "žluť", "cs"), (10, "žluť", "sk")]
    trees = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True))
    best, _, bits = trees.predict(["over the brown dog".encode(), "žluť".encode()])
    assert [trees.languages[b] for b in best] == ["en", "cs"]  # cs and sk tie: the first by name
    assert bits[0] < 3
