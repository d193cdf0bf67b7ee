"""Quality classifier: scores against plain sums, held-out accuracy, odd rows."""

import math
import os
import sys
import zlib

import numpy as np
import pyarrow.parquet as pq

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cardmill.llm import classifier, common  # noqa: E402
from cardmill.llm.queries import QUERIES  # noqa: E402

SF = os.environ.get("LLM_LABELS_DIR", "/root/testdata/sf0.01")


def test_features_are_counts_of_words_and_grams():
    found, share = classifier.features("Ab ab é")
    want = {zlib.crc32(b"\0\1") % classifier.BUCKETS: 1}  # one word stands right before as well
    for word in ("ab", "ab", "é"):
        names = [(word, 0)] + [(f"<{word}>"[i : i + k], k) for k in classifier.GRAMS for i in range(len(word) + 3 - k)]
        for name, k in names:
            b = zlib.crc32(name.encode(), k) % classifier.BUCKETS
            want[b] = want.get(b, 0) + 1
    assert dict(zip(found.tolist(), np.round(share * sum(want.values())).astype(int).tolist())) == want


def test_score_is_softmax_of_the_averaged_vectors():
    chance = np.random.default_rng(3)
    samples = []
    for i in range(40):
        text = " ".join(chance.choice(["good", "fine", "words"] if i % 2 else ["b@d", "###", "b@d%"], 20))
        samples.append((*classifier.features(text), i % 2))
    model = classifier.fit(samples)
    scorer = classifier.Scorer(model)
    for text in ("good words", "b@d ###", "", "unseen things " * 3):
        found, share = classifier.features(text)
        logit = float((share * model.weight[found]).sum()) + model.bias
        assert abs(scorer.score(text) - 1 / (1 + math.exp(-logit))) < 1e-6
    assert scorer.score("good words fine") > 0.9 > 0.1 > scorer.score("b@d ### b@d%")
    again = classifier.fit(samples)
    assert again.bias == model.bias and (again.weight == model.weight).all()


def test_fit_without_labels():
    for samples in ([], [(*classifier.features("one label"), 1)] * 3):
        model = classifier.fit(samples)
        assert classifier.Scorer(model).score("any text") == classifier.Scorer(model).score("")


def test_held_out_accuracy(spark):
    labels = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{SF}/labels.parquet").to_pylist()}
    rows = QUERIES["op13_quality_classifier"](spark, SF).collect()
    assert len(rows) == pq.read_table(f"{SF}/documents.parquet", columns=["doc_id"]).num_rows
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    judged = [(r.score, r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    good, bad = [s for s, _, q in judged if q], [s for s, _, q in judged if not q]
    area = sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad))
    accuracy = sum(p == q for _, p, q in judged) / len(judged)
    print(f"held out: {len(judged)}, area {area:.4f}, accuracy {accuracy:.4f}")
    assert area > 0.9 and accuracy > 0.9


def test_odd_rows(spark):
    common.prepare(spark)
    long = "w" * 200_000 + " " + "word " * 50_000
    texts = [(1, None), (2, ""), (3, " \t\n"), (4, long), (None, "no id"), (5, "twice"), (5, "twice"), (6, "日本語")]
    df = spark.createDataFrame([(i, t, 1, 0.5, True) for i, t in texts], "doc_id long, text string, label int, score double, held_out boolean")
    labels = [(1, 0, 0), (1, 1, 0), (2, None, 0), (None, 1, 1), (3, 1, 0), (4, 0, 0), (5, 1, 1), (99, 1, 0)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = classifier.train(df, labels)
    rows = classifier.classify(df, model).collect()
    assert len(rows) == len(texts)
    assert len({r.score for r in rows if r.doc_id in (1, 2, 3)}) == 1
    assert len({r.score for r in rows if r.doc_id == 5}) == 1
    assert all(0 <= r.score <= 1 for r in rows)
    assert classifier.classify(df.limit(0), classifier.train(df.limit(0), labels.limit(0))).count() == 0
