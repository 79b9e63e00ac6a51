import corpus_pipeline
from tests.conftest import SF001
from tests.llm.test_ngram_join import brute
from tests.llm.test_packing import verify


def test_stages_take_effect_in_order(spark):
    """Each stage against its operator's definition on what the stage before kept."""
    from lakeshore.llm import quality, toxicity

    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "toxicity", "near_duplicates", "packing"]
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    columns = docs.columns
    good = {r.doc_id for r in quality.op6_quality_rules(spark, SF001).where("kept").collect()}
    first = corpus_pipeline.quality_stage(spark, docs, SF001)
    assert first.columns == columns and {r.doc_id for r in first.collect()} == good

    model = toxicity.train(first, spark.read.parquet(f"{SF001}/labels.parquet"))
    matcher = model.matcher()
    clean = {r.doc_id: r.text for r in first.collect() if matcher.score(r.text) < 0.5}
    second = corpus_pipeline.toxicity_stage(spark, first, SF001)
    assert second.columns == columns and {r.doc_id for r in second.collect()} == set(clean)

    single = {i: t for i, t in clean.items() if brute_class(clean)[i] == i}
    third = corpus_pipeline.near_duplicate_stage(spark, second, SF001)
    assert third.columns == columns and {r.doc_id for r in third.collect()} == set(single)

    rows = corpus_pipeline.run(spark, SF001).collect()
    verify(rows, list(single.items()))


_classes: dict = {}


def brute_class(docs):
    if not _classes:
        _classes.update({i: c for i, (_, c) in brute(docs).items()})
    return _classes


def test_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string"
    good = " ".join(f"the plain{k} of word{k}," for k in range(60))
    rows = [(1, good, "en", "s", 1, "clash"), (1, good, "en", "s", 1, "clash"), (2, good, "en", None, None, None), (3, None, None, None, None, None),
            (None, good, "en", None, None, None)]
    docs = spark.createDataFrame(rows, schema)
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs, empty = stage(spark, docs, SF001), stage(spark, empty, SF001)
        assert empty.count() == 0, name
        assert {r.doc_id for r in docs.collect()} == ({1, 2} if name in ("quality", "toxicity") else {1}), name


def test_rows_of_one_doc_id_are_judged_by_their_own_text(spark):
    schema = "doc_id long, text string, lang string"
    one, two = (" ".join(f"the {name}{k} of word{k}{name}," for k in range(60)) for name in ("plain", "other"))
    docs = spark.createDataFrame([(1, one, "en"), (1, two, "en"), (1, two, "en"), (1, "short", "en"), (1, None, "en"), (2, two + " x", None)], schema)
    first = corpus_pipeline.quality_stage(spark, docs, SF001)
    assert sorted(r.text for r in first.collect()) == sorted([one, two, two, two + " x"])
    third = corpus_pipeline.near_duplicate_stage(spark, first.where("doc_id = 1"), SF001)
    assert sorted(r.text for r in third.collect()) == sorted([one, two])
