"""Operators with a trained model: exact parts against brute force, the rest by held-out accuracy."""

import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pacecast.llm import langid, pii, quality, toxicity
from pacecast.llm.queries import QUERIES, remainder

SMALL = "/root/testdata/sf0.001"


def ppm_bits(counts, text, order):
    """Code length by definition: longest known context, escapes by kinds of followers, exclusion on the way down."""
    padded, bits = bytes(order) + text, 0.0
    for at in range(order, len(padded)):
        excluded, done = set(), False
        for k in range(order, -1, -1):
            followers = counts[k].get(padded[at - k : at])
            if not followers:
                continue
            left = {b: n for b, n in followers.items() if b not in excluded}
            if not left:
                continue
            total = sum(left.values()) + len(left)
            if padded[at] in left:
                bits += math.log2(total / left[padded[at]])
                done = True
                break
            bits += math.log2(total / len(left))
            excluded |= set(left)
        if not done:
            bits += math.log2(max(256 - len(counts[0].get(b"", {})), 1))
    return bits


def test_code_lengths_are_exact():
    rng = random.Random(1)
    train = {c: ["".join(rng.choice(c * 3 + "abc ") for _ in range(300)) for _ in range(4)] for c in ("xy", "zy")}
    langs, tables, trees = sorted(train), [], []
    for lang in langs:
        runs = langid.runs_of(bytes(langid.ORDER).join(t.encode() for t in train[lang]))
        found, n = np.unique(runs, return_counts=True)
        kept = n >= 2
        tables.append((found[kept], n[kept]))
        counts = [{} for _ in range(langid.ORDER + 1)]
        for run, k in zip(found[kept].tolist(), n[kept].tolist()):
            b = run.to_bytes(4, "big")
            for order in range(langid.ORDER + 1):
                own = counts[order].setdefault(b[3 - order : 3], Counter())
                own[b[3]] += k
        trees.append(counts)
    model = langid.ContextTrees(langs, tables)
    texts = [b"", b"x", b"xyxyab zy", "é unseen Q".encode(), *[t.encode()[:50] for t in train["zy"]]]
    got = model.code_lengths(texts)
    want = [[ppm_bits(trees[j], t, langid.ORDER) for j in range(2)] for t in texts]
    assert np.allclose(got, want)


def test_runs_are_proper_codes():
    """In every context the probabilities of all 256 bytes add up to one."""
    runs, n = np.unique(langid.runs_of(b"abracadabra abracadabra" * 3), return_counts=True)
    model = langid.ContextTrees(["a"], [(runs, n)])
    for context in (b"abr", b"ada", b"xyz", b"\0\0\0", b"xab"):
        every = np.array([int.from_bytes(context + bytes([b]), "big") for b in range(256)])
        assert np.exp2(-model.costs(every)).sum() == pytest.approx(1.0)


def test_language(docs, doc_rows, none):
    trees = langid.train(docs, remainder(4) != 2)
    got = langid.predict(docs, trees).collect()
    assert len(got) == len(doc_rows)
    for r in got:
        assert 0 <= r["score"] <= 1
    by = {r["doc_id"]: r for r in got}
    assert by[102]["lang_pred"] == by[103]["lang_pred"] == by[105]["lang_pred"] == "und"
    held = [r for r in doc_rows[:60]]
    assert sum(by[i]["lang_pred"] == lang for i, _, lang, *_ in held) >= 58
    unknown = langid.train(none, F.lit(True))
    assert unknown.languages == [] and {r["lang_pred"] for r in langid.predict(docs, unknown).collect()} == {"und"}
    assert langid.predict(none, trees).collect() == []


def test_language_held_out(spark):
    found = QUERIES["op1_language"](spark, SMALL).alias("f")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang")
    rows = found.join(docs, "doc_id").where("held_out and lang is not null").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in rows) / len(rows) > 0.9


def test_a_small_language_keeps_its_tree_beside_a_hot_one(spark):
    noise = "".join(random.Random(3).choices("abcdefghijklmnopqrstuvwxyz0123456789 .,;:!?-+*/=()[]{}<>#%&$@_~^|", k=2_600_000))
    rows = [(i, noise, "hot") for i in range(3)] + [(i, "žluťoučký kůň", "small") for i in (3, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    trees = langid.train(docs, F.lit(True))
    best, _, bits = trees.predict(["žluťoučký kůň".encode()])
    assert len(trees.levels[0]["runs"]) > 2_000_000
    assert trees.languages[best[0]] == "small" and bits[0] < 4


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_brute(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m.group() if c in "0123456789"]
            checksum = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits)))
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and (not 13 <= len(digits) <= 19 or checksum % 10):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def test_base_spans_by_definition():
    rng = random.Random(4)
    for _ in range(20_000):
        text = "".join(rng.choice("ab01123.@@-+ ()%..é٣") for _ in range(rng.randint(0, 40)))
        assert pii.base_spans(text) == base_brute(text)
    card = "4111 1111 1111 1111"
    for text in (card, f"x{card}9", "a.b@c.d@e.f", "1.2.3.4.5.6.7.8", "256.1.1.1 0001.2.3.4", "+1 (555) 010-9999 x"):
        assert pii.base_spans(text) == base_brute(text)


def test_base_spans_walk_long_runs_once():
    for text in ("a" * 200_000 + "@", "1" * 200_000, "1." * 100_000, "a@" * 100_000, "0" * 5000 + ".1.1.1", "+1" + " ." * 100_000):
        pii.base_spans(text)


@pytest.fixture(scope="module")
def field():
    return pii.train()


def test_viterbi_is_the_best_path(field):
    rng = np.random.default_rng(0)
    small = pii.Field({f"f{i}": i for i in range(4)})
    small.emit = rng.normal(size=small.emit.shape)
    small.step = rng.normal(size=small.step.shape)
    rows = [[[f"f{rng.integers(0, 4)}"] for _ in range(n)] for n in (1, 3, 2, 4)]
    scores, _ = small.emissions(rows)
    step = small.transitions()
    for i, (row, got) in enumerate(zip(rows, small.decode(rows))):
        def value(path):
            own = small.begin[path[0]] + sum(scores[i, t, y] for t, y in enumerate(path))
            return own + sum(step[a, b] for a, b in zip(path, path[1:]))
        best = max(itertools.product(range(len(pii.LABELS)), repeat=min(len(row), 3)), key=value) if len(row) <= 3 else None
        if best:
            assert value(best) == pytest.approx(value(got.tolist()))


def test_field_on_other_lines(field):
    hit = wrong = total = 0
    for line in pii.labelled_lines(200, seed=99):
        text, spans = pii.parse_line(line)
        found = [x for x in pii.field_spans([text], field)[0]]
        total += len(spans)
        hit += sum(s in found for s in spans)
        wrong += sum(f not in spans for f in found)
    assert hit / total > 0.9 and wrong / total < 0.1


def test_personal_data(docs, doc_rows, none, field):
    extra = [("call (407) 555-7710 now", "phone"), ('token = "0123abcd0123abcd0123abcd0123abcd"', "secret")]
    for text, kind in extra:
        base, spans = pii.all_spans([text], field)[0]
        assert base == [] and [s[0] for s in spans] == [kind], (text, spans)
    got = pii.find(docs, field).collect()
    assert len(got) == len(doc_rows)
    assert all(set(r["base"].split(",")) <= set(r["spans"].split(",")) or not r["base"] for r in got)
    assert pii.find(none, field).collect() == []
    text = "mail a.b@c.org or 10.0.0.1, thanks"
    base, spans = pii.all_spans([text], field)[0]
    assert pii.redact(text, spans) == "mail <EMAIL> or <IP>, thanks" and len(base) == 2
    after = {r["doc_id"]: r for r in pii.redacted(docs, field).collect()}
    assert set(docs.columns) == set(pii.redacted(docs, field).columns) and after[102]["text"] is None


def test_forest_tells_strangers(spark):
    rng = np.random.default_rng(0)
    usual = rng.normal(size=(500, 3)) * [1, 1, 0]
    forest = quality.IsolationForest(usual, np.array([1.0, 1.0, 1.0]))
    strange = np.array([[8.0, 0, 0], [0, 0, 3.0]])
    assert forest.score(strange).min() > np.quantile(forest.score(usual), 0.99)
    x = usual[:5]
    for i, row in enumerate(x):  # path lengths by walking each tree
        total = 0.0
        for f, s, d in zip(forest.feature, forest.split, forest.depth):
            node = 1
            while f[node] >= 0:
                node = 2 * node + (row[f[node]] >= s[node])
            total += d[node]
        want = 2 ** (-total / len(forest.feature) / forest.rest(forest.size))
        assert forest.score(x)[i] == pytest.approx(want)


def test_kneser_ney_shares_its_backoff():
    unigrams = {"bad": (0.0, 30.0), "day": (300.0, 30.0), "odd": (2.0, 0.0)}
    model = toxicity.KneserNey(unigrams, np.array([698.0, 40.0]), {}, {})
    assert np.allclose(model.scale, [0.1, 1.0])
    for c in (0, 1):  # both are distributions
        assert model.unigram[:, c].sum() == pytest.approx(1.0)
    assert model.ratio["bad"] > 2 > abs(model.ratio["odd"])
    assert toxicity.KneserNey({}, np.zeros(2), {}, {}).evidence("any text") == (0.0, 0.0, 0.0)


def test_texts_of_toxic_words_alone_keep_their_evidence():
    unigrams = {"bad": (0.0, 30.0), "vile": (0.0, 25.0), "day": (300.0, 30.0)}
    model = toxicity.KneserNey(unigrams, np.array([698.0, 40.0]), {}, {})
    for text in ("bad", "bad vile", "Bad, vile\nbad, vile"):
        assert min(model.evidence(text)) > 0.5
    assert model.evidence("day") == (0.0, 0.0, 0.0)


def test_toxicity(docs, doc_rows, labels, no_labels, none):
    model = toxicity.train(docs, labels, F.lit(True))
    got = toxicity.score_texts(docs, model).collect()
    assert len(got) == len(doc_rows) and all(0 <= r["score"] <= 1 for r in got)
    blank = toxicity.train(docs, no_labels, F.lit(True))
    assert len({r["score"] for r in toxicity.score_texts(docs, blank).collect()}) == 1
    assert toxicity.score_texts(none, model).collect() == []
    kept = toxicity.kept_rows(docs, model, 0.7)
    assert kept.columns == docs.columns and kept.where("text is null").count() == 2


def test_pairs_tell_whatever_the_rank_of_their_words(spark):
    names = ["".join("abcdefghij"[int(c)] for c in f"{i:05d}") for i in range(3000)]
    often, ordinary_alone = names[:1500], names[1500:]
    texts = []
    for i in range(200):
        toxic = i % 2
        own = ["kick rocks"] if toxic else ["rocks", *ordinary_alone, "kick"]
        texts.append((i, " ".join([*own, *often]) if i % 4 < 2 else " ".join(often + (own if not toxic else [])), toxic))
    docs = spark.createDataFrame([(i, t) for i, t, _ in texts], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in texts], "doc_id long, toxic int")
    models = toxicity.train(docs, labels, F.lit(True)).models
    assert min(models.evidence("kick rocks")) > 0
    assert models.evidence("rocks and kick") == (0.0, 0.0, 0.0)


def test_labels_of_held_out_rows_teach_nothing(docs, labels):
    trainable = remainder(3) != 1
    held = toxicity.training_rows(docs, labels, trainable).count()
    every = toxicity.training_rows(docs, labels, F.lit(True)).count()
    assert 0 < held < every


def test_labels_beyond_the_bound_are_shuffled(docs, labels, monkeypatch):
    few = toxicity.training_rows(docs, labels, F.lit(True)).collect()
    monkeypatch.setattr(toxicity, "SENT_LABELS", 0)
    assert Counter(toxicity.training_rows(docs, labels, F.lit(True)).collect()) == Counter(few)
