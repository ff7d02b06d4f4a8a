"""The pipeline stage by stage against brute force, over documents with planted copies, passages and odd rows."""

import random

import public_tokenizers
import pytest
import sentencepiece
from test_dedup import brute_groups, brute_phrases
from test_native import brute_hits

import corpus_pipeline
from riskspark.llm import language_id
from riskspark.llm.base import table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    r = random.Random(8)
    docs = [tuple(x) for x in table(spark, SF, "documents").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    items = [tuple(x) for x in table(spark, SF, "benchmark").collect()]
    texts = [d[1] for d in docs if d[1] and len(d[1].split()) > 60]
    passage = " ".join(texts[0].split()[:55])
    extra = [texts[1], texts[1] + " more", texts[2].replace(texts[2].split()[5], "other"), passage + " " + texts[3], texts[4] + "\n" + passage,
             "Some words first. " + items[0][1] + " And last.", None, "", "123 456", "a b", "a b"]
    made = docs + [(10_000 + i, t, r.choice(["en", None]), "extra", len(t or "")) for i, t in enumerate(extra)]
    out = tmp_path_factory.mktemp("pipeline")
    spark.createDataFrame(made, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{out}/benchmark.parquet")
    return str(out)


def test_stages_equal_brute_force(spark, folder):
    docs = table(spark, folder, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    stage = dict(corpus_pipeline.STAGES)
    results = {}
    for n in names:
        docs = stage[n](spark, docs, folder)
        rows = docs.collect()
        docs = spark.createDataFrame(rows, docs.schema)
        results[n] = rows
        if n != names[-1]:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    first = table(spark, folder, "documents")
    said = {r["doc_id"]: r for r in language_id.identify(first, language_id.learn(first)).collect()}
    all_rows = first.collect()
    kept = [r for r in all_rows if said[r["doc_id"]]["lang_pred"] != "und" and said[r["doc_id"]]["score"] >= 0.3]
    assert sorted(results[names[0]]) == sorted(kept) and len(all_rows) - 10 < len(kept) < len(all_rows)
    groups = brute_groups([(r["doc_id"], r["text"]) for r in kept])
    single = [r for r in kept if r["doc_id"] in {g[2] for g in groups}]
    assert sorted(results[names[1]]) == sorted(single) and len(single) < len(kept)
    cut = {r["doc_id"]: r["text"] for r in results[names[2]]}
    removed = {d: n for d, _, n, _ in brute_phrases([(r["doc_id"], r["text"]) for r in single], 13)}
    before = {r["doc_id"]: r["text"] for r in single}
    assert cut.keys() == before.keys() and any(removed.values())
    for d, t in cut.items():
        assert len(before[d].split()) - len(t.split()) == removed[d] and (removed[d] or t == before[d])
    items = [tuple(r) for r in table(spark, folder, "benchmark").collect()]
    dirty = {h[0] for h in brute_hits(list(cut.items()), items, 10) if h[-1]}
    assert {r["doc_id"] for r in results[names[3]]} == cut.keys() - dirty and 10_005 in dirty
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(corpus_pipeline.PIECE_MODEL))
    assert {r["doc_id"] for r in results[names[4]]} == cut.keys() - dirty
    for r in results[names[4]]:
        assert r["ids"] == library.encode(cut[r["doc_id"]], add_eos=True) and r["decoded"] == library.decode(r["ids"])


def test_pipeline_runs_over_stored_stages(spark, folder):
    out = corpus_pipeline.run(spark, folder)
    assert out.columns == ["doc_id", "ids", "begins", "ends", "decoded"] and out.count() > 100


def test_pipeline_of_an_empty_table(spark, folder, tmp_path):
    table(spark, folder, "documents").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    table(spark, folder, "benchmark").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
