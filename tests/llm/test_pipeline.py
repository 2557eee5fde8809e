"""The pipeline's stages against brute force, and the entry without the subpackage."""

import os
import shutil
import subprocess
import sys

import corpus_pipeline
import pytest
from helpers import AWKWARD, documents, words_of
from test_groups import brute
from test_tokens import check_sequences, whole

from linkloom.llm import common, packing

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
REPO = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@needs_tables
def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = kept[name] = common.stored(stage(spark, docs, SF_DIR), "test")
    columns = kept["documents"].columns
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert kept[name].columns == columns
    text = {r.doc_id: r.text for r in kept["documents"].collect()}
    ids = {name: sorted(r.doc_id for r in df.select("doc_id").distinct().collect()) for name, df in kept.items()}
    assert set(ids["quality"]) < set(ids["language"]) <= set(text)
    # every text with letters is in one of the four languages, most of them plainly
    assert len(ids["language"]) >= 0.95 * len(text)
    good = {r.doc_id for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").where("quality = 1").collect()}
    clean = {d for d in good if len(text[d].split()) >= 10} & set(ids["language"])
    assert len(clean & set(ids["quality"])) >= 0.97 * len(clean)
    groups = brute([(d, text[d]) for d in ids["quality"]], corpus_pipeline.NEAR)
    assert ids["near_duplicates"] == sorted(d for d, (_, component) in groups.items() if component == d)
    rows = kept["packing"].collect()
    check_sequences(rows, packing.CAPACITY)
    tokens = {d: len(whole("word_bpe_49k.json", text[d])) // 4 + 1 for d in ids["near_duplicates"]}
    assert sum(r.length for r in rows) == sum(tokens.values()) and {r.doc_id for r in rows} == set(tokens)
    whole_run = corpus_pipeline.run(spark, SF_DIR)
    key = lambda r: (r.doc_id, r.piece, r.length, r.ids_crc32)
    assert sorted(map(key, whole_run.collect())) == sorted(map(key, rows))


@needs_tables
def test_run_reads_the_tables(spark, tmp_path):
    os.makedirs(tmp_path / "sf")
    documents(spark, AWKWARD).write.parquet(str(tmp_path / "sf" / "documents.parquet"))
    for r in corpus_pipeline.run(spark, str(tmp_path / "sf")).collect():
        assert r.length > 0


def test_near_duplicates_keep_rows_without_an_id_and_texts_that_share_one(spark):
    a, b, c = (" ".join(words_of(k, 90)) for k in (1, 2, 3))
    near = lambda text: text.rsplit(" ", 1)[0]
    rows = [(5, a), (5, b), (3, near(a)), (None, near(b)), (None, c), (None, near(c)), (None, "short"), (5, b), (4, None), (6, "")]
    out = corpus_pipeline.near_duplicates(spark, documents(spark, rows), "nowhere").collect()
    kept = sorted(((r.doc_id, r.text) for r in out), key=repr)
    assert [r for r in kept if r[0] is not None] == sorted([(3, near(a)), (5, b), (4, None), (6, "")], key=repr)
    assert (None, "short") in kept and sum(t in (c, near(c)) for _, t in kept) == 1 and len(kept) == 6


def test_stages_take_awkward_and_empty_tables(spark):
    for rows in (AWKWARD, []):
        docs = documents(spark, rows)
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, "nowhere")
            assert out.count() <= (100 if rows else 0)


def test_entry_without_the_subpackage(tmp_path):
    """What the library looks like once the subpackage and the pipeline are taken out."""
    copy = tmp_path / "repo"
    shutil.copytree(REPO, copy, ignore=lambda folder, names: {".git", "__pycache__"} | ({"llm"} & set(names)) | ({"corpus_pipeline.py"} & set(names)))
    code = "import __spark_entry__ as e; q = e.queries(); assert q and 'pipeline' not in q and not any(n.startswith('op') and n[2].isdigit() for n in q)"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=copy, check=True, env=env)
