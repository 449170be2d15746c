import pickle
import random
import zlib

import numpy as np
import pytest
from pyspark import RDD
from pyspark.sql import functions as F

from strata.llm import toxicity as T
from strata.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"


def test_word_buckets():
    texts = [b"Hello, world! it's", None, b"", "ÉTÉ 42 été".encode(), b"HELLO a" + b"b" * 40]
    word, begin, counts = T.word_buckets(texts)
    assert counts.tolist() == [3, 0, 0, 3, 2] and len(word) == len(begin) == 8
    assert word[0] == word[6]  # A-Z count as a-z
    one = T.word_buckets([b"abcdefgh abcdxyz"])
    assert one[1][0] == one[1][1] and one[0][0] != one[0][1]
    assert T.word_buckets([])[0].size == 0 and T.word_buckets([b"..."])[2].tolist() == [0]


def test_blocks_pool_as_the_whole_text_does(monkeypatch):
    """Long texts go through the filters in blocks; the maxima are the same."""
    rng = np.random.default_rng(1)
    model = T.Cnn.new()
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 500, n)).encode() for n in (0, 1, 2, 3, 700, 5, 0)]
    word, begin, counts = T.word_buckets(texts)
    whole = model.pooled(word, begin, counts)
    monkeypatch.setattr(T, "BLOCK", 7)
    assert np.allclose(whole, model.pooled(word, begin, counts), atol=1e-5)
    x = model.words[word] + model.begins[begin]  # the definition, filter by filter
    at = np.concatenate(([0], np.cumsum(counts)))
    for d in range(len(counts)):
        v = x[at[d]:at[d + 1]]
        for i, width in enumerate(T.WIDTHS):
            best = [sum(v[j + k] @ model.conv[i][k] for k in range(width)) for j in range(len(v) - width + 1)]
            want = np.maximum(np.max(best, axis=0) + model.conv_bias[i], 0) if best else np.zeros(T.FILTERS)
            assert np.allclose(whole[d, i * T.FILTERS:(i + 1) * T.FILTERS], want, atol=1e-4)


def test_gradients_lower_the_loss():
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["aa", "bb", "cc", "dd"]) for _ in range(20)) + (" bad stuff" if i % 3 == 0 else "")
             for i in range(90)]
    y = np.array([int(i % 3 == 0) for i in range(90)])
    pairs = [T.word_buckets([t.encode()])[:2] for t in texts]
    model = T.fit(pairs, y, ["en"] * 90)
    s = model.score([t.encode() for t in texts])
    assert s[y == 1].min() > s[y == 0].max()


def test_held_out_accuracy(spark):
    rows = QUERIES["op5_toxicity"](spark, SF).collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = [(r.score, r.predicted, r.flagged, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    pos, neg = [x for x in held if x[3]], [x for x in held if not x[3]]
    auc = np.mean([(p[0] > q[0]) + 0.5 * (p[0] == q[0]) for p in pos for q in neg])
    assert auc > 0.95
    assert np.mean([p[2] for p in pos]) > 0.75 and np.mean([q[2] for q in neg]) < 0.05


def small(spark):
    docs = [(i, ("du bist ein schuft" if i % 4 == 0 else "ein schönes haus") + f" wort{i % 7}", "de", "s", i)
            for i in range(120)]
    docs += [(None, None, None, None, 0), (500, "", "en", "s", 0), (3, "ein schönes haus", "de", "s", 0),
             (501, "schuft " * 50_000, "de", "s", 0)]
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, score int")
    lab = [(i, 1, int(i % 4 == 0)) for i in range(100)] + [(None, 1, 1), (7, 1, None), (9999, 0, 1)]
    return d, spark.createDataFrame(lab, "doc_id long, quality int, toxic int")


def test_edge_cases(spark):
    docs, labels = small(spark)
    rows = T.score_documents(docs, labels).collect()
    assert len(rows) == 124
    by = {r.doc_id: r for r in rows}
    assert by[501].flagged and by[116].flagged and not by[117].flagged
    assert not by[500].flagged and not by[None].held_out and not by[None].flagged
    kept = T.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() == 124 - 30 - 1
    assert kept.where(F.col("text").contains("schuft")).count() == 0
    assert T.score_documents(docs.limit(0), labels).count() == 0
    for none in (labels.limit(0), labels.where("toxic = 0")):  # nothing to tell apart: all score alike and stay
        r = T.score_documents(docs, none).collect()
        assert len({x.score for x in r}) == 1 and not any(x.flagged for x in r)


def test_labels_and_columns_are_no_inputs(spark):
    """Other ids, languages and sources of a text change no score."""
    docs, labels = small(spark)
    model = T.train(docs, labels)
    a = docs.where("doc_id < 20").select("doc_id", "text", "lang")
    b = a.select((F.col("doc_id") + 1000).alias("doc_id"), "text", F.lit("xx").alias("lang"))
    x = sorted(r.score for r in T.add_scores(a, model).collect())
    assert x == sorted(r.score for r in T.add_scores(b, model).collect())


def test_held_out_labels_are_never_seen(spark):
    docs, labels = small(spark)
    turned = labels.withColumn("toxic", F.when(T.held_out(F.col("doc_id")), 1 - F.col("toxic"))
                               .otherwise(F.col("toxic")))
    a, b = T.train(docs, labels), T.train(docs, turned)
    assert (a.out == b.out).all() and (a.words == b.words).all() and a.scale == b.scale


@pytest.mark.parametrize("bound", [{"max_train": 10}, {"max_words": 40}])
def test_training_sample_is_bounded(spark, bound, monkeypatch):
    docs, labels = small(spark)
    seen = []
    monkeypatch.setattr(T, "fit", lambda texts, y, langs, **k: seen.append(texts) or T.Cnn.new())
    T.train(docs, labels, **bound)
    assert len(seen[0]) <= 10


def test_long_texts_leave_out_only_themselves(spark, monkeypatch):
    """A text over the word bound, first in hash order, does not empty the sample."""
    docs, labels = small(spark)
    ids = [r.doc_id for r in labels.where("doc_id < 100 and toxic is not null").where(~T.held_out(F.col("doc_id")))
           .orderBy(F.xxhash64("doc_id")).collect()]
    long = docs.where("doc_id is not null").dropDuplicates(["doc_id"]).withColumn(
        "text", F.when(F.col("doc_id") == ids[0], F.repeat(F.lit("haus "), 5000))
        .when(F.col("doc_id") == ids[1], F.repeat(F.lit("haus "), 1500)).otherwise(F.col("text")))
    seen, fit = [], T.fit
    monkeypatch.setattr(T, "fit", lambda texts, y, *a, **k: seen.append(len(texts)) or fit(texts, y, *a, **k))
    kept = T.drop_toxic(long, labels, max_words=2000)
    assert seen == [len(ids) - 1]  # the second one fits after the others
    assert kept.where("text like '%schuft%'").count() < 5 and kept.where("text like '%haus%'").count() > 80


def test_a_sample_without_either_label_raises(spark):
    docs, labels = small(spark)
    toxic = docs.withColumn("text", F.when(F.col("text").contains("schuft"), F.repeat(F.lit("schuft "), 300))
                            .otherwise(F.col("text")))
    with pytest.raises(ValueError, match="lacks one of the two labels"):
        T.train(toxic, labels, max_words=200)


def test_fitting():
    sizes = [(1, 0, 500), (2, 0, 90), (3, 0, 1), (4, 1, 2), (5, 0, 2), (6, 0, 60), (7, 1, 4)]
    assert T._fitting(sizes, 100) == {2, 3, 4, 5, 7}
    assert T._fitting(sizes, 1000) == {1, 2, 3, 4, 5, 6, 7} and T._fitting([], 9) == set()


def test_all_bytes_of_a_word_count():
    a, b, c = "donaudampfschifffahrts" + "kapitän", "donaudampfschifffahrts" + "kapitäm", "x" * 16 + "a" * 16
    word = T.word_buckets([f"{a} {b} {a} {c}b {c}c {c[:-1]}da".encode()])[0]
    assert word[0] == word[2] and len(set(word.tolist())) == 5


def test_unspaced_scripts_are_cut_into_characters():
    text = "abc今日は良い天気です、ですxyz ไทย 한국어 été 𠀀b"
    word, _, counts = T.word_buckets([text.encode(), "気".encode()])
    assert counts.tolist() == [1 + 9 + 1 + 2 + 1 + 3 + 1 + 1 + 2, 1]
    assert word[7] == word[-1]  # the same character, far into the run
    assert word[8] == word[11] and word[9] == word[12]


def test_all_labelled_texts_train(spark, monkeypatch):
    """More labelled texts than one shard holds are all used, in shards."""
    docs, labels = small(spark)
    n = labels.where("doc_id < 100 and toxic is not null").where(~T.held_out(F.col("doc_id"))).count()
    monkeypatch.setattr(T, "SHARD_TEXTS", 20)
    monkeypatch.setattr(T, "BATCH", 8)
    seen, fit = [], T.fit_shards
    monkeypatch.setattr(T, "fit_shards", lambda coded, *a, **k: seen.append(
        (coded.count(), coded.rdd.getNumPartitions(), a)) or fit(coded, *a, **k))
    a, b = T.train(docs, labels, threshold=0.7), T.train(docs, labels, threshold=0.7)
    assert seen[0][0] == seen[0][2][0] == n and seen[0][1] == -(-n // 20)
    assert np.allclose(a.words, b.words) and np.isclose(a.scale, b.scale)
    scores = {r.doc_id: r.score for r in T.add_scores(docs.where("doc_id < 120").select("doc_id", "text"), a).collect()}
    assert min(scores[i] for i in scores if i % 4 == 0) > max(scores[i] for i in scores if i % 4)


def test_thresholds_of_counted_scores():
    counts = np.zeros((T.BINS + 1, 2), np.int64)
    counts[100, 1], counts[3000, 0] = 50, 7
    assert T._best_bin(counts, 0.5) == 0.5 and T._best_bin(counts, 0.9) == 3000 / T.BINS


def test_what_the_driver_gets_does_not_grow_with_the_shards(spark, monkeypatch):
    """The shards' changes are averaged by tasks; one model reaches the driver."""
    docs, labels = small(spark)
    got, collect = [], RDD.collect
    monkeypatch.setattr(RDD, "collect", lambda self: got.append(collect(self)) or got[-1])
    most = []
    for texts in (20, 2):
        got.clear()
        monkeypatch.setattr(T, "SHARD_TEXTS", texts)
        T.train(docs, labels)
        most.append(max(len(pickle.dumps(x)) for x in got))
    assert most[1] <= 2 * most[0] and most[1] < 9e6


def test_mean_moves_of_shards():
    rng = np.random.default_rng(3)
    at = [np.array([1, 5, 600, 601]), np.array([5, 601, 2000])]
    moves = [rng.normal(size=(len(a), T.DIM)).astype(np.float32) for a in at]
    rest = [[np.full(2, x, np.float32)] for x in (1, 4)]
    by_key = {}
    for a, m, n, r in zip(at, moves, (1, 3), rest):
        for key, value in [*T._chunks(0, a, m), ((T.OTHERS, 0), (n, r))]:
            by_key.setdefault(key, []).append(value)
    got = {k: T._mean_move(k, v) for k, v in by_key.items()}
    assert np.allclose(got.pop((T.OTHERS, 0))[0], (1 * 1 + 3 * 4) / 4)
    rows = {int(i): m for i, v in got.values() for i, m in zip(i, v)}
    assert sorted(rows) == [1, 5, 600, 601, 2000]
    assert np.allclose(rows[5], (moves[0][1] + moves[1][0]) / 2) and np.allclose(rows[600], moves[0][2])


def test_texts_are_shuffled_once(spark, capsys):
    """Copies are combined and labels joined where the texts are; no label is broadcast."""
    docs, labels = small(spark)
    chosen = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    T._coded(docs, chosen).explain()
    plan = capsys.readouterr().out
    assert "Broadcast" not in plan and plan.count("Exchange hashpartitioning") == 2  # the texts, the labels
    twice = T._coded(docs.union(docs), chosen).collect()
    assert len(twice) == 100 and {r.n for r in twice if r.doc_id % 4 and r.doc_id != 3} == {4}
