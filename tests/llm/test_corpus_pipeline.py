import zlib

import numpy as np
import public_tokenizers
import pytest
from test_line_dedup import brute as without_repeats
from test_ngram_join import brute as components
from test_quality import verdicts
from test_tokens import check_pieces
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from hiretide.llm import pii
from hiretide.llm.common import stored


@pytest.fixture(scope="module", params=["sf0.001", "sf0.01"])
def results(spark, request):
    """What each stage gave, and the documents it was given."""
    sf_dir = f"/root/testdata/{request.param}"
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        given = docs
        docs = stored(stage(spark, docs, sf_dir), name)
        out[name] = (given.collect(), docs.collect(), docs.columns)
    return out


def as_rows(rows):
    return sorted(map(tuple, rows))


def test_stages_are_the_five_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "line_dedup", "near_duplicates", "pii", "packing"]


def test_columns_stay_until_the_last_stage(results):
    for name in list(results)[:-1]:
        assert results[name][2] == ["doc_id", "text", "lang", "source", "n_chars"]


def test_quality_rules(results):
    given, kept, _ = results["quality_rules"]
    good = verdicts([(r.text, r.lang, r.source) for r in given])
    assert as_rows(kept) == as_rows(r for r, (_, k) in zip(given, good) if k)
    assert len(kept) < len(given)


def test_line_dedup(results):
    given, left, _ = results["line_dedup"]
    of = {r.doc_id: r for r in given}
    wanted = [(i, t, of[i].lang, of[i].source, len(t)) for i, t, gone in without_repeats(
        [(r.doc_id, r.text) for r in given]) if not gone or t.strip()]
    assert as_rows(left) == sorted(wanted)


def test_near_duplicates(results):
    given, kept, _ = results["near_duplicates"]
    first = {i for i, _, c in components([(r.doc_id, r.text) for r in given]) if i == c}
    assert as_rows(kept) == as_rows(r for r in given if r.doc_id in first)


def test_pii(results):
    given, left, _ = results["pii"]
    assert as_rows(left) == sorted(
        (r.doc_id, t, r.lang, r.source, len(t)) for r in given for t in [pii.redact_text(r.text)])
    assert any(r.text != t.text for r, t in zip(sorted(given), sorted(left)))
    assert not any(pii.base_spans(r.text) for r in left)


def test_packing(results):
    given, pieces, _ = results["packing"]
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    check_pieces(pieces, {r.doc_id: [*t.encode(r.text, add_special_tokens=False).ids, 2] for r in given})


def test_run_gives_the_last_stage(spark, results):
    if len(results["quality_rules"][0]) == 200:
        rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
        assert sum(r.length for r in rows) == sum(r.length for r in results["packing"][1])


def test_stages_take_odd_rows(spark, edge_docs, no_docs):
    for docs in (edge_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, "")
            assert out.columns == docs.columns
            assert out.count() <= docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() >= docs.count()


def test_registered():
    names = set(entry.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in names and names >= set(entry.oracle_sql())


def test_nothing_outside_imports_the_subpackage():
    import pathlib

    root = pathlib.Path(corpus_pipeline.__file__).parent
    for source in (root / "hiretide").rglob("*.py"):
        if "llm" not in source.parts:
            assert "llm" not in source.read_text()


def test_crc_is_that_of_the_ids():
    assert zlib.crc32(np.array([1, 2], "<u4").tobytes()) == zlib.crc32(bytes([1, 0, 0, 0, 2, 0, 0, 0]))
