import random
import zlib

from lakeshore.llm import toxicity
from lakeshore.llm.toxicity import Matcher, Model, _contexts, fold, score, train
from tests.conftest import SF01


def test_folding_makes_disguises_plain():
    for text in ("idiot", "1d10t", "IDI0T", "іdіоt", "ídïòt", "ｉｄｉｏｔ", "idi\u200bot", "ld1ot"):
        assert fold(text).strip() == "idiot", text
    assert fold("$tupid as$hat cost $5").split()[1] == "asshat"
    assert fold("") == "  "


def test_longest_match_word_starts_and_exceptions():
    matcher = Matcher(Model({" trash ": 2.0, fold("lowei")[:-1]: 3.0}, (" trash can ",)))
    assert [w for _, w in matcher.hits(fold("Trash, loweiä and slowei trashy"))] == [2.0, 3.0]
    assert matcher.hits(fold("the trash can")) == []
    assert Matcher(Model({})).hits(fold("anything")) == []


def corpus(spark):
    rows, labels = [], []
    for i in range(300):
        toxic = i % 5 == 0
        text = " ".join(f"word{(i * 13 + k * 7) % 211}" for k in range(40)) + (" you M0R0N and loser" if toxic else " a trash can")
        rows.append((i, text + (" trash" if toxic else ""), "x"))
        labels.append((i, 1, int(toxic), "extra"))
    labels += [(None, 1, 1, None), (5, None, None, None), (9999, 1, 1, None), (0, 1, 1, "again")]
    docs = spark.createDataFrame([*rows, (None, None, None), (1000, "", None)], "doc_id long, text string, score string")
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string")


def test_training_finds_the_words_and_scores_all_rows(spark):
    docs, labels = corpus(spark)
    model = train(docs, labels)
    for word in ("moron", "loser"):  # as a whole or by its beginning
        assert any(fold(word).startswith(entry) for entry in model.weights)
    scored = score(docs, model)
    assert scored.columns == ["doc_id", "text", "score"] and scored.count() == docs.count()
    for r in scored.collect():
        assert 0 <= r.score <= 1
        if r.doc_id is not None and r.doc_id < 300:
            assert (r.score >= 0.5) == (r.doc_id % 5 == 0)
        else:
            assert r.score < 0.5


def test_every_qualified_entry_is_in_the_lexicon(spark):
    """400 words of four candidates each, of which the shortest beginning covers the others."""
    words = [f"{a}{b}{c}xyzuvw" for a in "abcdefghij" for b in "abcdefgh" for c in "stuvw"]
    rows = [(f, 50, 0) for w in words for f in (f" {w} ", f" {w[:4]}", f" {w[:5]}", f" {w[:6]}")]
    rows += [(" weak ", 3, 0), (" both ", 50, 50), (" abs ", 50, 0)]
    kept = toxicity._lexicon(spark.createDataFrame(rows, "feature string, pos long, neg long"), 100, 100)
    assert set(kept) == {f" {w[:4]}" for w in words} | {" abs "}


def test_labels_of_the_held_out_fold_are_not_read(spark):
    docs, labels = corpus(spark)
    out = [i for i in range(300) if zlib.crc32(str(i).encode()) % 5 == 0]
    turned = labels.selectExpr("doc_id", "quality", f"if(doc_id in ({','.join(map(str, out))}), 1 - toxic, toxic) as toxic")
    assert train(docs, turned) == train(docs, labels)


def test_without_labels_or_rows(spark):
    docs, labels = corpus(spark)
    assert train(docs, labels.limit(0)) == Model({})
    assert score(docs.limit(0), Model({})).count() == 0
    assert {r.score < 0.5 for r in score(docs, Model({})).collect()} == {True}


def test_held_out_accuracy_of_the_query(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}
    rows = toxicity.op5_toxicity(spark, SF01).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    judged = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(p == y for p, y in judged) >= 0.9 * len(judged)
    clean = [p for p, y in judged if y == 0]
    assert sum(clean) <= 0.05 * len(clean)


def plain_hits(model, folded):
    """Every entry looked for at every place, every match compared with every exception."""
    void = [(i, i + len(p) - 1) for p in model.exceptions for i in range(len(folded)) if folded.startswith(p, i)]
    out = []
    for i in range(len(folded)):
        fits = [p for p in model.weights if folded.startswith(p, i)]
        if fits and not any(a <= i < b for a, b in void):
            out.append((i, model.weights[max(fits, key=len)]))
    return out


def test_matches_equal_plain_search():
    rng = random.Random(4)
    words = ["ab", "abc", "abcd", "b", "ba", "cab", "dd"]
    for _ in range(300):
        entries = {f" {w}" + rng.choice(["", " "]): rng.random() for w in rng.sample(words, 3)}
        phrases = tuple({f" {' '.join(rng.choices(words, k=rng.randrange(1, 4)))} " for _ in range(3)})
        model = Model(entries, phrases)
        text = fold(" ".join(rng.choices(words, k=rng.randrange(0, 30))))
        assert model.matcher().hits(text) == plain_hits(model, text)


def test_many_matches_and_exceptions():
    model = Model({" bad ": 1.0}, (" bad dog ",))
    assert len(model.matcher().hits(fold("bad dog, bad man " * 100_000))) == 100_000


def test_neighbours_are_whole_words():
    model = Model({" bad ": 1.0})
    long = "x" * 500
    assert _contexts(model)()(fold(f"{long} bad {long} y")) == {" bad ", f" {long} bad ", f" bad {long} "}
    assert _contexts(model)()(fold("bad")) == {" bad "}
    assert _contexts(model)()(fold("good")) == set()
