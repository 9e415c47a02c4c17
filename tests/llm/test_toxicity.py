import pickle
import zlib

import numpy as np
import pytest

from hourlake.llm import queries, toxicity


def test_forward_backward():
    rng = np.random.default_rng(0)
    n = 700
    emit, first = rng.normal(size=n) * 2, rng.random(n) < 0.02
    first[0] = True
    start, move = np.exp([0, 0.3]), np.exp(rng.normal(size=(2, 2)))
    shown = np.stack([np.ones(n), np.exp(emit)], 1)
    a, b = np.zeros((n, 2)), np.ones((n, 2))
    for k in range(n):
        a[k] = (start if first[k] else a[k - 1] @ move) * shown[k]
        a[k] /= a[k].sum()
    for k in range(n - 2, -1, -1):
        b[k] = 1 if first[k + 1] else move @ (shown[k + 1] * b[k + 1])
        b[k] /= b[k].sum()
    forward, back = toxicity.forward_backward(emit, first, start, move)
    want, got = a * b, forward * back
    assert np.allclose(want[:, 1] / want.sum(1), got[:, 1] / got.sum(1), atol=1e-12)


def texts(n=200):
    rng = np.random.default_rng(1)
    out = []
    for k in range(n):
        words = [f"w{x}" for x in rng.integers(0, 400, 60)]
        if toxic := k % 4 == 0:
            for at in rng.integers(0, 60, 4):
                words[at] = ["idiot", "moron!", "Scum"][rng.integers(3)]
        out.append((" ".join(words), int(toxic)))
    return out


def test_fit_and_spans():
    data = texts()
    model = pickle.loads(pickle.dumps(toxicity.fit([t for t, _ in data], [y for _, y in data])))
    tokens = [["w1", "idiot", "w2"], [], ["w5"] * 50, ["a", "moron!", "Scum", "b"]]
    found = model.marginals(tokens)
    scores = model.scores(model.evidence(tokens, found))
    assert scores[3] > 0.5 > scores[1] and scores[2] < 0.5 and ((0 <= scores) & (scores <= 1)).all()
    assert toxicity.spans("a  moron! Scum b", found[-4:])[0] | {"p": 0} == {"begin": 3, "end": 14, "p": 0}


def test_copies_of_a_toxic_text_do_not_make_its_words_toxic():
    data = texts() + [("only in these copies idiot moron", 1)] * 300
    model = toxicity.fit([t for t, _ in data], [y for _, y in data])
    assert "w:copies" not in model.weights and "w:idiot" in model.weights


@pytest.mark.parametrize("labels", [[], [0, 0], [1, 1]])
def test_one_kind_only(labels):
    model = toxicity.fit(["a b"] * len(labels), labels)
    assert 0 <= float(model.scores(np.array([[1.0, 0, 0]]))[0]) <= 1


def test_frames(spark):
    data = texts(80)
    rows = [(k, t, "x", 1.0) for k, (t, _) in enumerate(data)] + [(500, None, None, None), (501, "", "x", None), (None, "idiot", None, None), (0, data[0][0], "x", 1.0), (502, "w1 " * 50000 + "scum moron idiot", "x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxicity string, score double")
    labels = spark.createDataFrame([(k, y, None) for k, (_, y) in enumerate(data)] + [(None, 1, None), (3, None, None), (0, 1, None)], "doc_id long, toxic int, text string")
    model = toxicity.train(docs, labels)
    out = toxicity.score(docs, model).select("doc_id", "text", "toxicity.*").collect()
    assert len(out) == len(rows)
    by = {r["doc_id"]: r for r in out}
    assert by[502]["score"] >= 0.5 and by[502]["spans"][0]["begin"] == 150000 and by[500]["score"] == by[501]["score"] < 0.5 and by[500]["spans"] == []
    assert toxicity.score(docs.limit(0), model).count() == 0
    assert toxicity.train(docs.limit(0), labels.limit(0))


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = queries.QUERIES["op2_toxicity"](spark, sf).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in held]) >= 0.95
