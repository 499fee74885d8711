"""Quality and toxicity scores, and packing, against plain Python on small tables."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from starledger.llm import quality_model, toxicity
from starledger.llm.packing import pack_documents
from starledger.llm.quality_model import POOLED, SPHERE, TEMPERATURE, quality_scores, statistics
from starledger.llm.queries import tokenizer_path
from starledger.llm.toxicity import changes, features, sentences, toxicity_scores, words_in

GROUPS = ["women", "muslims", "immigrants", "black", "gay"]
DOCS = "doc_id bigint, text string, score string, x string, label string"


def _held_out(i: int) -> bool:
    return zlib.crc32(str(i).encode()) % 5 == 0


def _documents(n: int = 160, seed: int = 5) -> tuple[list[tuple], list[tuple]]:
    """Texts and (id, quality, toxic); hateful ones name groups more often than others do."""
    rnd = random.Random(seed)
    plain = [f"word{i}" for i in range(60)]
    rows, labels = [], []
    for i in range(1, n + 1):
        good, bad = i % 3 > 0, i % 4 == 0
        words = [rnd.choice(plain) for _ in range(rnd.randrange(5, 60))]
        if bad:
            words.insert(rnd.randrange(5), rnd.choice(["vermin", "filth"]))  # among those that junk repeats
        if rnd.random() < (0.8 if bad else 0.1):
            words.insert(rnd.randrange(len(words)), rnd.choice(GROUPS))
        if not good:
            words = [w.upper() + "#$" * rnd.randrange(3) for w in words[:6]] * rnd.randrange(2, 9)
        text = " ".join(w + rnd.choice([".", "", "", "\n"]) for w in words)
        rows.append((i, text, "clash", "x", None))
        labels.append((i, int(good), int(bad)))
    odd = [None, "", " \n", "é" * 5000, "same. " * 4000, rows[0][1]]
    rows += [(n + 1 + k, t, None, None, "0") for k, t in enumerate(odd)]
    return rows, labels


@pytest.fixture(scope="module")
def tables(spark):
    rows, labels = _documents()
    noise = [(None, 1, 1), (99999, 1, 0), (3, None, None), (5, 7, 7)]
    return (
        spark.createDataFrame([*rows, rows[2], (None, "no id", None, None, None)], DOCS).repartition(4),
        spark.createDataFrame(labels + noise, "doc_id bigint, quality int, toxic int"),
    )


def _quality(rows, labels) -> dict[int, float]:
    """Shrunk class covariances by numpy, densities by inverses and determinants."""
    x = {i: np.array(statistics((t or "").encode())) for i, t, *_ in rows}
    parts = [np.array([x[i] for i, q, _ in labels if q == c and not _held_out(i)]) for c in (0, 1)]
    n = sum(map(len, parts))
    pooled = sum(np.cov(p.T, bias=True) * len(p) for p in parts) / n + 1e-6 * np.eye(x[1].size)
    densities = []
    for p in parts:
        cov = (1 - POOLED) * np.cov(p.T, bias=True) + POOLED * pooled
        cov = (1 - SPHERE) * cov + SPHERE * np.diag(np.diag(pooled))
        prior = TEMPERATURE * np.log(len(p) / n) - 0.5 * np.linalg.slogdet(cov)[1]
        inverse = np.linalg.inv(cov)
        densities.append(lambda v, m=p.mean(axis=0), s=inverse, b=prior: b - 0.5 * (v - m) @ s @ (v - m))
    return {i: 1 / (1 + np.exp(np.clip((densities[0](v) - densities[1](v)) / TEMPERATURE, -500, 500))) for i, v in x.items()}


def test_quality_scores_equal_plain_discriminant(tables):
    rows, labels = _documents()
    got = quality_scores(*tables).collect()
    assert Counter(r.doc_id for r in got) == Counter([*[r[0] for r in rows], rows[2][0], None])
    want = _quality(rows, labels)
    for r in got:
        if r.doc_id is not None:
            assert abs(r.score - want[r.doc_id]) < 1e-6 and r.held_out == _held_out(r.doc_id)
        assert r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1
    truth = {i: q for i, q, _ in labels if _held_out(i)}
    right = [r.predicted == truth[r.doc_id] for r in got if r.doc_id in truth]
    assert len(right) > 20 and sum(right) >= 0.9 * len(right)


def test_quality_does_not_read_held_out_labels(tables):
    docs, labels = tables
    turned = labels.withColumn("quality", F.when(quality_model.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert quality_scores(docs, labels).exceptAll(quality_scores(docs, turned)).isEmpty()


def _whole(words: list[set[str]]) -> set[str]:
    return set().union(*[features(w) for w in words]) if words else set()


def test_changes_equal_rewriting_each_sentence():
    texts = [
        "Women sing. The women and womenfolk dance! No names here.\nMuslims pray, muslims rest",
        "black black. white? Black people; asian food", "", None, "nothing at all", "women",
    ]
    for text in texts:
        parts, want = sentences(text), set()
        assert set().union(*parts) == words_in(text)
        for i, part in enumerate(parts):
            for name in part & toxicity._PARTNERS.keys():
                for partner in toxicity._PARTNERS[name]:
                    after = _whole([*parts[:i], (part - {name}) | {partner}, *parts[i + 1 :]])
                    want.add((frozenset(_whole(parts) - after), frozenset(after - _whole(parts))))
        found = changes(text)
        assert len(found) == len(set(found)) and set(found) == want


def test_changes_of_a_very_long_text_stay_few():
    found = changes("women and men of all kinds meet here. " * 20_000)
    assert 0 < len(found) <= 14


def _toxic_model(spark, rows, labels, weight):
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    return toxicity.train(docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"), weight=weight)


def _score(model, text):
    total = model[""] + sum(model.get(f, 0.0) for f in features(words_in(text)))
    return 1 / (1 + np.exp(-total))


def test_toxicity_scores_equal_plain_fit(spark, tables):
    rows, labels = _documents()
    got = toxicity_scores(*tables).collect()
    assert Counter(r.doc_id for r in got) == Counter([*[r[0] for r in rows], rows[2][0], None])
    texts = {i: t for i, t, *_ in rows}
    again = [rows[2][0]]  # a row that the table has twice is learnt from twice
    learnt = [(texts[i], y) for i, _, y in labels for _ in range(1 + (i in again)) if not _held_out(i)]
    docs = spark.createDataFrame(learnt, "text string, y int")
    names = toxicity.choose_features(docs)
    index = {f: i for i, f in enumerate(names)}
    x = [[index[f] for f in features(words_in(t)) if f in index] for t, _ in learnt]
    rewritten = []
    for text, _ in learnt:
        own = features(words_in(text))
        new = [{f for f in (own - a) | b if f in index} for a, b in changes(text)]
        rewritten.append([sorted(index[f] for f in s) for s in new if s != {f for f in own if f in index}])
    w = toxicity.fit(np.array([y for _, y in learnt]), x, rewritten, len(names))
    for r in got:
        if r.doc_id is not None:
            total = w[-1] + sum(w[index[f]] for f in features(words_in(texts[r.doc_id])) if f in index)
            assert abs(r.score - 1 / (1 + np.exp(-total))) < 1e-6 and r.held_out == _held_out(r.doc_id)
        assert r.predicted == int(r.score >= 0.5)
    truth = {i: y for i, _, y in labels if _held_out(i)}
    right = [r.predicted == truth[r.doc_id] for r in got if r.doc_id in truth]
    assert len(right) > 20 and sum(right) >= 0.9 * len(right)


def test_neutral_mentions_of_groups_score_less_with_the_penalty(spark):
    rows, labels = _documents()
    free, held = (_toxic_model(spark, rows, labels, weight) for weight in (0.0, 10.0))
    neutral = [f"word1 word2. The {g} of word3 word4 word5." for g in GROUPS]
    spread = [np.ptp([_score(m, t) for t in [*neutral, "word1 word2. The people of word3 word4 word5."]]) for m in (free, held)]
    assert spread[1] < 0.5 * spread[0]
    assert sum(_score(held, t) >= 0.5 for t in neutral) <= sum(_score(free, t) >= 0.5 for t in neutral)
    assert sum(_score(held, t) for t in neutral) < sum(_score(free, t) for t in neutral)
    assert all(_score(held, f"word1 word2 vermin {g} word3") > _score(held, f"word1 word2 word9 {g} word3") for g in GROUPS)


@pytest.mark.parametrize("scores", [quality_scores, toxicity_scores])
def test_no_documents_and_labels_of_one_class(spark, tables, scores):
    docs, labels = tables
    assert scores(docs.limit(0), labels).isEmpty()
    column = "quality" if scores is quality_scores else "toxic"
    one = labels.filter(F.col(column) == 1)
    assert {r.score for r in scores(docs, one).collect()} == {1.0}
    assert scores(docs, labels.limit(0)).select("score").distinct().count() == 1


def test_every_column_of_packed_pieces(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    rows, _ = _documents(30)
    rows = [*rows, rows[4], (None, "no id here", None, None, None)]
    want = Counter()
    for i, text, *_ in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for k in range(0, len(ids), 128):
            part = ids[k : k + 128]
            want[i, k, len(part), zlib.crc32(part.tobytes()), len(ids)] += 1
    got = pack_documents(spark.createDataFrame(rows, DOCS).repartition(3), tokenizer_path(), size=128).collect()
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == want
    filled = Counter()
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == filled[r.sequence_id]
        filled[r.sequence_id] += r.length
    assert sorted(filled) == list(range(len(filled))) and max(filled.values()) <= 128
    assert pack_documents(spark.createDataFrame([], DOCS), tokenizer_path()).isEmpty()
