"""Language profiles: held-out accuracy, and the rules for odd texts."""

import subprocess
import sys

import numpy as np
import pyarrow as pa

from tidemart.llm import language, queries
from tidemart.llm.text import table

FOLDER = "/root/testdata/sf0.001"


def test_held_out_accuracy(spark):
    told = queries.language_of_documents(spark, FOLDER)
    docs = table(spark, FOLDER, "documents").select("doc_id", "lang")
    held_out = told.filter("held_out").join(docs, "doc_id")
    right, every = held_out.filter("lang = lang_pred").count(), held_out.count()
    assert every > 20 and right >= 0.95 * every
    assert told.filter("score < 0 or score > 1").count() == 0 and told.count() == docs.count()


def test_odd_texts(spark):
    learned = spark.createDataFrame(
        [("the cat and the dog", "en"), ("der hund und die katze", "de"), (None, "fr"), ("le chat", None)], "text string, lang string")
    prototypes = language.learn(learned)
    assert list(prototypes) == ["de", "en"]
    df = spark.createDataFrame(
        [(1, "THE dog", "x"), (2, "und die", "x"), (3, None, "x"), (4, "", "x"), (5, "12 !? $", "x"), (6, "日本語", "x"),
         (1, "THE dog", "x"), (7, "the dog " * 3000, "x")], "doc_id long, text string, score string")
    got = {r.doc_id: r for r in language.predict(df, prototypes).collect()}
    assert [got[k].lang_pred for k in (1, 2, 3, 4, 5, 7)] == ["en", "de", "und", "und", "und", "en"]
    assert got[3].score == got[5].score == 0.0 and 0 < got[7].score <= 1 and got[6].lang_pred in prototypes
    assert language.predict(df, prototypes).count() == 8


def test_nothing_learned_and_no_rows(spark):
    nothing = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    assert language.learn(nothing) == {}
    assert language.predict(nothing, {}).first().lang_pred == "und"
    assert language.predict(nothing.limit(0), {}).count() == 0


def test_counts_of_a_text_do_not_depend_on_its_neighbours():
    alone, _ = language.counted([" ab  c "])
    among, _ = language.counted([" xx ", " ab, c ", " ... ", " ab c "])
    assert alone[0][1].tolist() == among[1][1].tolist() == among[3][1].tolist()
    assert alone[0][0].tolist() == among[1][0].tolist() and len(among[2][0]) == 0


def test_parts_and_blocks_change_nothing(monkeypatch):
    texts = pa.array(["Ein Hund, ΟΔΟΣ und İ 日本語" * 9, "", "the dog...  " * 20, "x", "..." * 30], pa.large_string())
    whole = {}
    for start, counts in language.steps(texts):
        whole.update({start + k: v for k, v in enumerate(language.bundle(counts))})
    for step, block in ((7, 3), (40, 5)):
        monkeypatch.setattr(language, "STEP_BYTES", step)
        monkeypatch.setattr(language, "BLOCK", block)
        parts = {k: np.zeros(language.DIMENSIONS) for k in whole}
        for start, counts in language.steps(texts):
            for k, vector in enumerate(language.bundle(counts)):
                parts[start + k] += vector
        assert all((parts[k] == whole[k]).all() for k in whole)


def test_a_text_of_100_mb_takes_a_bounded_amount_of_memory():
    code = """
import numpy as np, pyarrow as pa
from tidemart.llm import language
word = np.random.default_rng(1).integers(97, 123, (1 << 20, 5), np.uint8)
word[:, 4] = 32
texts = pa.array([word.tobytes() * 20], pa.large_binary()).cast(pa.large_string())
del word
total = sum(language.bundle(counts)[0] for _, counts in language.steps(texts))
assert len(total) == language.DIMENSIONS and np.linalg.norm(total) > 0
# Not ru_maxrss: that starts from the peak of the process that ran the tests.
print(next(int(x.split()[1]) // 1024 for x in open("/proc/self/status") if x.startswith("VmHWM")))
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True)
    assert int(done.stdout.split()[-1]) < 500
