"""Operators with exact results against plain Python."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from pacecast.llm import decontam, lengths, quality, sharding, simhash, sptok, tokenbin
from pacecast.llm.queries import BYTE_BPE, PIECES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BPE, MODEL = public_tokenizers.path(BYTE_BPE), public_tokenizers.path(PIECES)


def key(row):
    return tuple((v is not None, v) if not isinstance(v, list) else (True, v) for v in row)


def same(got, want):
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(BPE)
    t.encode_special_tokens = True
    return t


def text_hash(text):
    """The hash that orders the texts of one id: signed XXH64 of seed 42, which is the seed itself for null."""
    h = 42 if text is None else xxhash.xxh64_intdigest(text.encode(), 42)
    return h - (1 << 64) if h >> 63 else h


def by_id(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, text_hash(r[1]), r[1] or ""))


@pytest.mark.parametrize("row_length,batch_rows", [(16, 4), (2048, 256)])
def test_token_files(docs, doc_rows, tokenizer, tmp_path, monkeypatch, row_length, batch_rows):
    monkeypatch.setattr(tokenbin, "BATCH_ROWS", batch_rows)
    manifest = tokenbin.write_token_files(docs, f"file://{tmp_path}/t", BPE, 2, row_length, 1 << 17)
    want, start, stream = [], 0, []
    for i, text, *_ in by_id(doc_rows):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        stream += ids
        start += len(ids)
    same(tokenbin.read_token_files(manifest).collect(), want)
    got = []
    for r in manifest.orderBy("file_no").collect():
        file = tokenbin.TokenFile(r["file"])
        rows = [file[i] for i in range(len(file))]
        assert all(len(ids) == row_length and not ids.flags.owndata for ids, _ in rows)
        within = [(b.address, b.address + b.size) for k in range(file.reader.num_record_batches) for b in file.reader.get_batch(k).column(1).flatten().buffers() if b]
        assert all(any(a <= m.buffers()[1].address < z for a, z in within) for _, m in rows)  # masks are views as well
        assert all(m.true_count == row_length for _, m in rows[:-1])
        got += [int(x) for ids, m in rows for x in ids[m.to_numpy(zero_copy_only=False)]]
        with pytest.raises(IndexError):
            file[len(file)]
    assert got == stream
    assert not list(tmp_path.glob("t/_unfinished*"))


def test_token_files_of_nothing(none, tmp_path):
    assert tokenbin.token_files(none, BPE, 2, f"file://{tmp_path}/t").collect() == []


@pytest.mark.parametrize("equal", [False, True])
def test_token_files_of_one_id(spark, tmp_path, equal):
    """Rows of one (null) id, or all equal, spread over the files."""
    text = F.lit("the same few words") if equal else F.concat(F.lit("text "), F.col("id").cast("string"))
    docs = spark.range(4000).repartition(4).select(F.lit(None).cast("long").alias("doc_id"), F.repeat(text, 4).alias("text"))
    manifest = tokenbin.write_token_files(docs, f"file://{tmp_path}/t", BPE, 2, 64, 1 << 15).collect()
    assert len(manifest) > 4 and sum(r["n_docs"] for r in manifest) == 4000
    assert max(r["n_docs"] for r in manifest) < 2000


def test_word_cache_equals_library(tokenizer):
    from pacecast.llm.wordcache import WordCache

    rng = np.random.default_rng(0)
    letters = list("abcXé中 \t\n  '.!12") + ["  ", "<|endoftext|>", "'ll", "\x1c "]
    texts = ["".join(rng.choice(letters, rng.integers(0, 60))) for _ in range(1500)]
    cache = WordCache(BPE)
    got = [np.frombuffer(p, cache.dtype).tolist() for p in cache.encode(texts)]
    assert got == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_shards(docs, doc_rows, none):
    got = sharding.interleave(docs, shards=8, slice_rows=10).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in doc_rows
    )
    counts = Counter(r["shard"] for r in got)
    assert max(counts.values()) - min(counts.values()) <= 1 and set(counts) == set(range(8))
    for s, n in counts.items():
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(n))
    by_source = Counter((r["source"], r["shard"]) for r in got)
    for source, n in Counter(r["source"] for r in got).items():
        assert all(abs(by_source[source, s] - n / 8) < 2 for s in range(8))
    order = sorted(got, key=lambda r: (r["shard"], r["slot"]))
    assert [r["fraction"] for r in order] == sorted(r["fraction"] for r in got)
    one = sharding.interleave(docs, shards=8).collect()
    assert Counter(map(tuple, one)) == Counter(map(tuple, got))  # the slices don't show in the result
    assert sharding.interleave(none).collect() == []


@pytest.mark.parametrize("kind", ["null ids", "equal ids", "equal rows", "one row a source"])
def test_shards_of_hot_keys(spark, kind):
    """No slice or cut grows with a key; results stay whole."""
    n, slices = 20_000, 20
    made = {"null ids": F.lit(None).cast("long"), "equal ids": F.lit(7).cast("long"), "equal rows": F.lit(7).cast("long")}
    text = F.lit("copy") if kind == "equal rows" else F.concat(F.lit("t"), F.col("id").cast("string"))
    source = F.col("id").cast("string") if kind == "one row a source" else F.lit("hot")
    docs = spark.range(n).select(made.get(kind, F.col("id")).alias("doc_id"), text.alias("text"), source.alias("source"))
    rows = sharding.sliced(sharding.distinct_rows(docs), slices, "s")
    largest = rows.groupBy("source", "_slice").count().agg(F.max("count")).first()[0]
    assert largest < 2 * n / slices
    ranked = sharding._numbered(rows, ["source"], "_slice", ["_key", *sharding.ROW], "_rank")
    cuts = sharding.mixed(ranked, slices, "s").groupBy("_cut").count().agg(F.max("count")).first()[0]
    assert cuts < 2 * n / slices
    got = sharding.interleave(docs, shards=3, slice_rows=1000)
    places = got.groupBy("shard").agg(F.count("slot").alias("n"), F.countDistinct("slot").alias("d"), F.max("slot").alias("top"))
    assert all(abs(r["n"] - n / 3) < 1 and r["n"] == r["d"] == r["top"] + 1 for r in places.collect())


def test_write_shards(docs, tmp_path, spark):
    sharding.write_shards(docs, f"file://{tmp_path}/shards", shards=3)
    assert spark.read.parquet(f"file://{tmp_path}/shards").count() == docs.count()


def windows_brute(doc_rows, items, window=10):
    find = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall
    wins = {}
    for item, text in items:
        w = find((text or "").translate(LOWER))
        for k in range(max(1, len(w) - window + 1) if w else 0):
            wins.setdefault(tuple(w[k : k + window]), set()).add(str(item))
    out = []
    for i, text, *_ in doc_rows:
        w, hit, named = find((text or "").translate(LOWER)), set(), set()
        for win, ids in wins.items():
            for k in range(len(w) - len(win) + 1):
                if tuple(w[k : k + len(win)]) == win:
                    hit |= set(range(k, k + len(win)))
                    named |= ids
        out.append((i, len(w), len(hit), ",".join(sorted(named))))
    return out


@pytest.mark.parametrize("block_bytes", [1 << 25, 2000])
def test_decontaminate(docs, doc_rows, benchmark, none, monkeypatch, block_bytes):
    monkeypatch.setattr(decontam, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(decontam.in_blocks, "__defaults__", (block_bytes,))
    found = decontam.per_row(decontam.decontaminate(docs, benchmark))
    want = windows_brute(doc_rows, [tuple(r)[:2] for r in benchmark.collect()])
    assert any(n for *_, n in want)
    same(found.select("doc_id", "n_words", "n_hit", F.concat_ws(",", "items")).collect(), want)
    if block_bytes > 1 << 20:
        assert decontam.decontaminate(none, benchmark).collect() == []
        clean = decontam.per_row(decontam.decontaminate(docs, benchmark.limit(0)))
        assert clean.where("n_hit > 0").count() == 0 and clean.count() == len(doc_rows)


def test_decontamination_stays_native(docs, benchmark):
    texts = decontam.texts_of(docs)
    keys = decontam.window_keys(decontam.benchmark_windows(benchmark), decontam.word_counts(texts, texts.select(F.lit("a").alias("word"))))
    plan = keys._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|ArrowEval|MapInArrow", plan)


def fingerprint_brute(text, size=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(w[i : i + size]) for i in range(len(w) - size + 1)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_brute(pairs, most):
    roots = list(range(len(pairs)))

    def find(i):
        while roots[i] != i:
            i = roots[i]
        return i

    for i, (_, a) in enumerate(pairs):
        for j in range(i):
            if (a ^ pairs[j][1]).bit_count() <= most:
                x, y = find(i), find(j)
                roots[max(x, y)] = min(x, y)
    least = {}
    for i, (d, _) in enumerate(pairs):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [(d, f, least.get(find(i))) for i, (d, f) in enumerate(pairs)]


@pytest.mark.parametrize("node_rows", [100_000, 7])
def test_simhash(docs, doc_rows, none, node_rows):
    pairs = [(i, fingerprint_brute(t)) for i, t, *_ in doc_rows]
    got = simhash.near_duplicates(docs, node_rows=node_rows).collect()
    same([(r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in got], components_brute(pairs, 2))
    if node_rows > 7:
        assert simhash.near_duplicates(none).collect() == []


@pytest.mark.parametrize("visitors", [200_000, 50])
def test_index_loses_no_link(spark, monkeypatch, visitors):
    """Clustered fingerprints over many small nodes, visitors dealt over shares, against all pairs."""
    monkeypatch.setattr(simhash, "TASK_VISITORS", visitors)
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 1 << 63, 12, dtype=np.uint64)
    fps = {int(c) for c in centres} | {0, (1 << 64) - 1}
    for _ in range(500):
        fp = int(centres[rng.integers(0, 12)])
        for b in rng.integers(0, 64, rng.integers(1, 6)):
            fp ^= 1 << int(b)
        fps.add(fp)
    signed = [f - (1 << 64) if f >> 63 else f for f in sorted(fps)]
    distinct = spark.createDataFrame([(f,) for f in signed], "fp long").withColumn("rank", simhash._gray_column("fp"))
    roots = simhash.components(simhash.near_links(distinct, node_rows=20)).collect()
    group = {f: f for f in signed} | {r["node"]: r["root"] for r in roots}
    want = components_brute([(f, f % (1 << 64)) for f in signed], 2)
    parts = lambda pairs: {frozenset(a for a, b in pairs if b == c) for c in {b for _, b in pairs}}
    assert parts([(f, group[f]) for f in signed]) == parts([(f, c) for f, _, c in want])


def test_gray_rank(spark):
    assert simhash.gray_rank(np.array([0, 1, 3, 2, 6, 7, 5, 4])).tolist() == list(range(8))
    column = spark.createDataFrame([(-1,), (6,)], "fp long").select(simhash._gray_column("fp").alias("r")).collect()
    ranks = simhash.gray_rank(np.array([-1, 6]))
    assert [r["r"] + (1 << 63) for r in column] == ranks.tolist()


def test_components_of_a_chain(spark):
    links = spark.range(40).selectExpr("id as a", "id + 1 as b")
    got = simhash.components(links).collect()
    assert {(r["node"], r["root"]) for r in got} == {(i, 0) for i in range(1, 41)}
    assert simhash.components(links.limit(0)).collect() == []


@pytest.fixture(scope="module")
def library():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=MODEL)


def test_sentencepiece(docs, doc_rows, none, library):
    got = sptok.encode_decode(docs, MODEL).collect()
    want = []
    for i, text, *_ in doc_rows:
        ids = library.encode(text or "", add_eos=True)
        want.append((i, ids, library.decode(ids)))
    same(got, want)
    assert sptok.encode_decode(none, MODEL).collect() == []


def test_pieces_equal_library(library):
    rng = np.random.default_rng(1)
    vocabulary = sptok.Pieces(MODEL)
    letters = list("abcdeinrstT.,'▁ 0\n\t#é中😀ñ<x_-()\x00ﷺ") + ["  ", "   ", "<0x0A>", "</s>", "the", "ing"]
    texts = [*["".join(rng.choice(letters, rng.integers(0, 40))) for _ in range(3000)], " " * 37, "▁▁a", "aaaaaaaaaaaaa" * 9]
    got = [np.frombuffer(p, "<i4").tolist() for p in vocabulary.encode(texts)]
    assert got == library.encode(texts, add_eos=True)
    assert [vocabulary.decode(i) for i in got] == [library.decode(i) for i in got]
    for _ in range(2000):
        ids = [int(x) for x in rng.integers(0, 300 if rng.random() < 0.5 else 32_000, rng.integers(0, 12))]
        assert vocabulary.decode(ids) == library.decode(ids)


def test_backtracking_gives_the_merged_text(library):
    vocabulary = sptok.Pieces(MODEL)
    rng = np.random.default_rng(2)
    for _ in range(300):
        unit = "".join(rng.choice(list("▁aeinrst"), rng.integers(1, 14)))
        assert [vocabulary.text[i] for i in vocabulary.encode_unit(unit)] == vocabulary.merged(unit)


def test_lengths(docs, doc_rows, none, tokenizer):
    table = lengths.limits(lengths.histogram(docs, BPE)).cache()
    size = {}
    for _, text, lang, *_ in doc_rows:
        size.setdefault(lang, []).append(len(tokenizer.encode(text or "", add_special_tokens=False).ids))
    want = []
    for lang, n in size.items():
        n = np.array(n)
        for limit in np.unique(n):
            more = n[n > limit]
            want.append((lang, limit, (n == limit).sum(), len(more), more.sum(), len(n), n.sum(), np.minimum(n, limit).sum()))
    got = table.select("group", "length", "n", "n_longer", "tokens_longer", "n_docs", "total_tokens", "truncated_total")
    same(got.collect(), [tuple(x if isinstance(x, str) or x is None else int(x) for x in w) for w in want])
    for q in (0.1, 0.5, 1.0):
        for r in lengths.quantile(table, q).collect():
            n = np.sort(size[r["group"]])
            assert r["length"] == n[int(np.ceil(q * len(n))) - 1]
    for r in lengths.truncated_total(table, 77).collect():
        assert r["truncated_total"] == np.minimum(size[r["group"]], 77).sum()
    assert lengths.limits(lengths.histogram(none, BPE)).collect() == []


def rule_brute(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    times = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
    hit = {k + j for k in range(len(w) - 2) if times[tuple(w[k : k + 3])] > 1 for j in range(3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


def test_rule_counts(docs, doc_rows, none, labels, no_labels):
    want = [(i, *rule_brute(t or "")) for i, t, *_ in doc_rows]
    counted = quality.statistics(docs)
    same(counted.select("doc_id", *quality.COUNTS[:5]).collect(), want)
    texts = ["", "a b a b a b", "x\nx\n \nx", "é#$ é#$ ü", "\x1c a\x85b   c", "a\r\na\r\n"]
    assert [quality.rule_counts(t.encode())[:5] for t in texts] == [rule_brute(t) for t in texts]
    judged = quality.judge(docs, labels).collect()
    assert len(judged) == len(doc_rows)
    for r in judged:
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])
    unlabelled = quality.judge(docs, no_labels).collect()
    assert all(r["kept"] != r["base_failed"] for r in unlabelled)
    assert quality.judge(none, labels).collect() == []


def test_sha_is_of_joined_ids(spark, library):
    from pacecast.llm.queries import op4_sentencepiece

    got = op4_sentencepiece(spark, "/root/testdata/sf0.001").limit(20).collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in got:
        ids = library.encode(docs[r["doc_id"]] or "", add_eos=True)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
