"""What Python workers hold once another operator's tasks run in them."""

import gc
import os
import subprocess
import sys
from pathlib import Path

import pyarrow as pa

SCRIPT = """
from hourlake.sources.session import create_session
from tests.llm.test_memos import in_workers
from hourlake.llm import line_dedup, toxicity
import pickle

spark = create_session("memos", "local[1]", **{"spark.sql.shuffle.partitions": "2", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
docs = spark.createDataFrame([(k, f"some words of text {k}") for k in range(200)], "doc_id long, text string")
toxicity.score(docs, pickle.dumps(toxicity.fit(["bad words"] * 9 + ["fine text"] * 9, [1] * 9 + [0] * 9))).collect()
before = in_workers(spark)
line_dedup.dedup_lines(docs).collect()
print("HELD", before, in_workers(spark))
"""


ENCODER = """
from hourlake.sources.session import create_session
from tests.llm.test_memos import most_memory
from hourlake.llm import sentencepiece_codec
import public_tokenizers

spark = create_session("encoder", "local[1]", **{"spark.sql.shuffle.partitions": "2", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
docs = spark.range(0, 2000, 1, 1).selectExpr("array_join(transform(sequence(1, 900), i -> hex(pmod(xxhash64(id, i), 1000000))), ' ') AS text")
path = public_tokenizers.path("piece_bpe_32k.model")
sentencepiece_codec.round_trip(docs.limit(1), path).collect()
before = most_memory(spark)
sentencepiece_codec.round_trip(docs, path).write.format("noop").mode("overwrite").save()
print("HELD", before, most_memory(spark))
"""


def most_memory(spark) -> int:
    """MB that the worker has had at most."""

    def probe(batches):
        for _ in batches:
            yield pa.RecordBatch.from_arrays([pa.array([int(Path("/proc/self/status").read_text().partition("VmHWM:")[2].split()[0]) // 1024])], ["n"])

    return spark.range(0, 1, 1, 1).mapInArrow(probe, "n long").first()["n"]


def in_workers(spark) -> int:
    """Entries of memos in the workers."""

    def probe(batches):
        for _ in batches:
            yield pa.RecordBatch.from_arrays([pa.array([entries()])], ["n"])

    return sum(r["n"] for r in spark.range(1).mapInArrow(probe, "n long").collect())


def entries() -> int:
    from hourlake.llm.bpe import Memo

    return sum(len(m) + len(m.elder) for m in gc.get_objects() if isinstance(m, Memo))


def test_line_dedup_holds_no_memo_of_the_stage_before():
    root = Path(__file__).resolve().parent.parent.parent
    run = subprocess.run([sys.executable, "-c", SCRIPT], cwd=root, env=os.environ | {"PYTHONPATH": str(root)}, capture_output=True, text=True, timeout=300)
    before, after = map(int, run.stdout.partition("HELD ")[2].split())
    assert before >= 200 and after == 0


def test_encoder_takes_little_memory_for_many_new_words():
    root = Path(__file__).resolve().parent.parent.parent
    run = subprocess.run([sys.executable, "-c", ENCODER], cwd=root, env=os.environ | {"PYTHONPATH": str(root)}, capture_output=True, text=True, timeout=300)
    before, after = map(int, run.stdout.partition("HELD ")[2].split())
    assert 0 < after - before < 285


def test_forget_spares_its_own():
    from hourlake.llm.bpe import Memo, forget

    own, other = Memo(len, most=2), Memo(len, most=2)
    for memo in (own, other):
        assert [memo[w] for w in ("a", "bb", "ccc")] == [1, 2, 3] and memo.elder
    forget(own)
    assert own and own.elder and not other and not other.elder and other["bb"] == 2
