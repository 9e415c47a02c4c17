"""The pipeline's stages, each held against a plain version on what the stage before kept, and on a table with the odd cases."""

import hashlib
import math
import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from test_documents import CLASHES, brute_components, brute_lines, shingles

from hourlake.llm import mixing, toxicity
from hourlake.llm.common import stored

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
ODD = [
    (None, None, "en", None, None),
    (1, "", "en", "a", 0),
    (2, None, None, "b", None),
    (3, "one two three\none two three\nfour five six seven eight nine ten", "en", "a", 60),
    (3, "one two three\none two three\nfour five six seven eight nine ten", "en", "a", 60),
    (4, "four five six seven eight nine ten", "en", None, 36),
    (5, "word " * 30_000, "en", "b", 150_000),
    (6, "word " * 30_000 + "other", "en", "b", 150_005),
    (None, "four five six seven eight nine ten", "de", "a", 36),
]


def score_of(model, text):
    """The score of one text by one step after another."""
    tokens = text.split()
    log_odds = [model.bias + sum(model.weights.get(f, 0.0) for f in toxicity.features(t)) for t in tokens]
    shown = [np.array([1.0, math.exp(max(-30.0, min(30.0, x)))]) for x in log_odds]
    start, move = np.exp([0.0, model.start]), np.exp(model.move)
    forward, back = [], [np.ones(2)]
    for s in shown:
        forward.append((forward[-1] @ move if forward else start) * s)
        forward[-1] = forward[-1] / forward[-1].sum()
    for s in shown[:0:-1]:
        back.append(move @ (s * back[-1]))
        back[-1] = back[-1] / back[-1].sum()
    found = [(f * b)[1] / (f * b).sum() for f, b in zip(forward, back[::-1], strict=False)]
    evidence = np.array([1.0, math.log1p(sum(found)), max(found, default=0.0)])
    return 1 / (1 + math.exp(-max(-40.0, min(40.0, float(evidence @ model.logistic)))))


def brute_toxicity(spark, docs):
    labels = toxicity.training_rows(spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic"))
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 for r in labels.collect())
    model = toxicity._model(toxicity.train(docs, labels))
    return [r for r in docs.collect() if score_of(model, r["text"] or "") < 0.5]


def brute_lines_cut(spark, docs):
    rows = docs.withColumn("h", F.xxhash64(F.coalesce("text", F.lit("")))).collect()
    gone = brute_lines([(r["doc_id"], r["text"], r["h"]) for r in rows])
    out = []
    for r in rows:
        n, cut = gone[r["doc_id"], r["text"] or ""]
        if not cut or len(cut) < n:
            text = r["text"] if not cut else "\n".join(x for k, x in enumerate(r["text"].split("\n")) if k not in cut)
            out.append((r["doc_id"], text, r["lang"], r["source"], None if text is None else len(text)))
    return out


def brute_near(spark, docs):
    rows = docs.collect()
    least = brute_components([(r["doc_id"], r["text"], None) for r in rows], 5)
    out = {}
    for r in rows:
        s = frozenset(shingles(r["text"], 5))
        if not s or least[s] == r["doc_id"]:
            out[r["doc_id"], r["text"] or ""] = tuple(r[c] for c in COLUMNS)
    return list(out.values())


def brute_mix(spark, docs):
    rows = mixing.mix(docs).collect()  # which other tests hold against SQL
    return [tuple(r[c] for c in COLUMNS) for r in rows for _ in range(r["mix"]["times"])]


def brute_encoding(spark, docs):
    made = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    out = []
    for r in docs.collect():
        ids = made.encode(r["text"] or "", add_bos=True, add_eos=True)
        out.append((r["doc_id"], r["source"], len(ids), bytes(np.array(ids, "<u4")), hashlib.sha256(made.decode(ids).encode()).hexdigest()))
    return out


BRUTE = {"toxicity": brute_toxicity, "line dedup": brute_lines_cut, "near-dedup": brute_near, "mixing": brute_mix, "encoding": brute_encoding}


def as_rows(rows):
    return sorted(repr(tuple(bytes(v) if isinstance(v, bytearray) else v for v in r)) for r in rows)


@pytest.mark.parametrize("table", ["sf0.001", "odd"])
def test_stages(spark, table):
    docs = spark.read.parquet(f"{SF}/documents.parquet") if table == "sf0.001" else spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        after = stored(stage(spark, docs, SF), "test-stage")
        assert as_rows(after.collect()) == as_rows(BRUTE[name](spark, docs)), name
        if name != "encoding":
            assert after.columns == docs.columns == COLUMNS
        docs = after
    assert docs.count() > 0


def test_empty_tables_and_columns_of_any_name(spark):
    odd = spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string, n_chars long")
    clashing = odd.drop("n_chars").select("*", *[F.lit(c).alias(c) for c in CLASHES])
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd.limit(0), SF).count() == 0, name
        out = stage(spark, clashing, SF)
        if name != "encoding":
            assert out.columns == clashing.columns
            assert all([r[c] for c in CLASHES] == CLASHES for r in out.collect())


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and "ids" in out.columns


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "near-dedup", "mixing", "encoding"]
    import __spark_entry__ as entry

    assert "pipeline" in entry.queries() and sum(n.startswith("op") for n in entry.queries()) == 10


def test_entry_without_what_llm_needs(monkeypatch):
    """Where something that the subpackage imports is absent, the other queries are there all the same."""
    import sys

    import __spark_entry__ as entry

    for name in [m for m in sys.modules if m.startswith("hourlake.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "xxhash", None)
    names = entry.queries()
    assert "row_count" in names and not any(n.startswith("op") for n in names) and "pipeline" not in names and set(entry.oracle_sql()) <= set(names)
