import math
from collections import Counter

from pyspark.sql import functions as F

from conftest import values
from weirflow.operators import text as tx
from weirflow.operators import recommend as ratings_by
from weirflow.operators.recommend import dense_index, fold_errors, fold_predictions, rmse, top_items, with_folds, with_int_ids
from weirflow.plans.topics import contrast_corpora, play_log, ratings_from_csv, recommend


def test_tokens(frame):
    df = frame("t string", ("Hello  @bob, see https://x.test/a?b or www.y.test - don't PANIC",))
    assert df.select(tx.tokens(F.col("t"))).first()[0] == ["hello", "SCREEN_NAME", "see", "URL", "or", "URL", "don't", "panic"]
    assert df.select(tx.topic_tokens(F.col("t"))).first()[0] == ["hello", "SCREEN_NAME", "panic"]


def test_lemmas(frame):
    df = frame("d long, toks array<string>", (1, ["mice", "houses", "mice"]), (2, ["sky"]))
    lemmas = frame("word string, lemma string", ("mice", "mouse"), ("houses", "house"))
    rows = {r.d: r.toks for r in tx.lemmatize(df, "d", "toks", lemmas).collect()}
    assert rows == {1: ["mouse", "house", "mouse"], 2: ["sky"]}


DOCS = [(1, ["aa", "bb", "aa"]), (2, ["aa", "cc"]), (3, ["bb", "cc", "dd"]), (4, ["ee"])]


def test_vocabulary_limits(frame):
    df = frame("d long, toks array<string>", *DOCS)
    assert values(tx.vocabulary(df, "toks", 2, 0.5, 10)) == [("aa", 2), ("bb", 2), ("cc", 2)]
    assert values(tx.vocabulary(df, "toks", 2, 0.4, 10)) == []
    assert values(tx.vocabulary(df, "toks", 1, 1.0, 2)) == [("aa", 2), ("bb", 2)]


def test_tfidf_by_hand(frame):
    df = frame("d long, toks array<string>", *DOCS)
    vocab = tx.vocabulary(df, "toks", 1, 1.0, 100)
    freq = Counter(t for _, toks in DOCS for t in set(toks))
    want = []
    for d, toks in DOCS:
        raw = {t: n * math.log2(4 / freq[t]) for t, n in Counter(toks).items()}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        want += [(d, t, Counter(toks)[t], round(v / norm, 6)) for t, v in raw.items()]
    assert values(tx.tfidf(df, "d", "toks", vocab)) == sorted(want, key=str)


def test_phrases_by_hand_and_joined(frame):
    rows = [(i, ["new", "york", "rain", "new", "york"]) for i in range(4)] + [(9, ["new", "car"]), (10, ["york"]), (11, [])]
    df = frame("d long, toks array<string>", *rows)
    words = Counter(t for _, toks in rows for t in toks)
    pairs = Counter(p for _, toks in rows for p in zip(toks, toks[1:]))
    size = len(words) + len(pairs)
    want = [(a, b, n, round((n - 1) / words[a] / words[b] * size, 6)) for (a, b), n in pairs.items() if n > 1 and (n - 1) / words[a] / words[b] * size > 0.2]
    assert values(tx.phrases(df, "toks", 1, 0.2)) == sorted(want, key=str)
    found = frame("a string, b string", ("new", "york"), ("york", "rain"))
    joined = {r.d: r.toks for r in tx.join_phrases(df, "d", "toks", found).collect()}
    assert joined[0] == ["new_york", "rain", "new_york"] and joined[9] == ["new", "car"] and joined[11] == []


def test_topics_per_label(spark):
    words = {1: ["apple", "pears", "plums"], 0: ["stone", "metal", "glass"]}
    rows = [(i, " ".join(words[i % 2][: 2 + i % 3] * 3), i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "d long, t string, good int")
    out = contrast_corpora(df, "t", "d", "good", [1, 0], min_docs=2, max_share=0.9, k=2, words=3)
    assert out.groupBy("good").agg(F.countDistinct("topic").alias("n")).filter("n <> 2").count() == 0
    # a topic no document uses may hold anything; the used ones hold the label's words
    best = {(r.good, r.term) for r in out.filter("rank = 0").collect()}
    assert all(best & {(label, w) for w in words[label]} for label in (0, 1))


# --- ratings ---------------------------------------------------------------------------------


def ratings(spark):
    return spark.range(400).selectExpr("id % 20 AS user_id", "id % 37 AS product_id", "CAST(1 + (id % 20 + id % 37) % 5 AS DOUBLE) AS rating").distinct()


def test_every_fold_is_predicted_once(spark):
    data = ratings(spark)
    predicted = fold_predictions(data, 3, rank=4).cache()
    assert predicted.select("user_id", "product_id").distinct().count() == predicted.count() <= data.count()
    assert {r.fold for r in fold_errors(predicted).collect()} == {0, 1, 2}
    assert rmse(predicted) > 0
    top = top_items(predicted, 5)
    assert top.groupBy("user_id").count().filter("count > 5").count() == 0
    best = {r.user_id: r.prediction for r in top.filter("rank = 1").collect()}
    assert best == {r.user_id: r.m for r in predicted.groupBy("user_id").agg(F.max("prediction").alias("m")).collect()}


def test_folds_repeat(spark):
    data = ratings(spark)
    assert values(with_folds(data)) == values(with_folds(data.repartition(7)))


def test_dense_index_and_long_ids(spark):
    df = spark.range(1000).selectExpr("id * 3000000000 AS k")
    out = dense_index(df, "k", "i")
    assert [r.i for r in out.orderBy("k").collect()] == list(range(1000))
    big = spark.createDataFrame([(2**31 + 5, 1, 3.0), (7, 2, 4.0)], "user_id long, product_id long, rating double")
    assert values(with_int_ids(big), "user_id", "user") == [(2**31 + 5, 1), (7, 0)]


def test_recommend_from_csv(spark, tmp_path):
    (tmp_path / "r.csv").write_text("".join(f"{p},{u},{1 + (u + p) % 5}\n" for u in range(12) for p in range(10)))
    data = ratings_from_csv(spark, str(tmp_path / "r.csv"))
    assert data.columns == ["product_id", "user_id", "rating"] and data.count() == 120
    top, errors = recommend(data, 2)
    assert top.count() > 0 and errors.count() == 3


def test_play_log(frame):
    out = play_log(frame("track_id long, user_id long", (1, 2)), frame("track_id long, title string", (1, "s")), frame("user_id long, city string", (2, "c")))
    assert values(out, "track_id", "user_id", "title", "city") == [(1, 2, "s", "c")]


def test_overlapping_phrases_join_left_to_right(frame):
    toks = ["a", "a", "a", "b", "a", "a", "c"]
    df = frame("d long, toks array<string>", (1, toks), (2, ["a"] * 9), (3, None))
    found = frame("a string, b string", ("a", "a"), ("a", "b"))

    def greedy(words):
        out, i = [], 0
        while i < len(words):
            if tuple(words[i : i + 2]) in {("a", "a"), ("a", "b")}:
                out, i = [*out, "_".join(words[i : i + 2])], i + 2
            else:
                out, i = [*out, words[i]], i + 1
        return out

    got = {r.d: r.toks for r in tx.join_phrases(df, "d", "toks", found).collect()}
    assert got == {1: greedy(toks), 2: greedy(["a"] * 9), 3: None}


def test_unseen_items_are_predicted_too(frame):
    data = frame("user_id long, product_id long, rating double", *[(u, u * 10 + p, 3.0) for u in range(4) for p in range(3)], (99, 999, 5.0))
    got = fold_predictions(data)
    assert got.count() == 13 and got.filter("prediction IS NULL OR isnan(prediction)").count() == 0


def test_an_iteration_of_als_leaves_no_shuffle_files(spark, monkeypatch):
    """With one iteration more, no more than the checkpoints' interval of shuffle files may lie on disk."""
    fitted = []
    plain = ratings_by._als
    monkeypatch.setattr(ratings_by, "_als", lambda *a: fitted.append(plain(*a)) or fitted[-1])
    data = spark.createDataFrame([(u, p, float((u + p) % 5 + 1)) for u in range(12) for p in range(8)], "user_id long, product_id long, rating double")
    assert fold_predictions(data, 3, rank=2).count() == 96
    assert len(fitted) == 3 and {als.getCheckpointInterval() for als in fitted} == {1}
    assert spark.sparkContext.getCheckpointDir() is not None


def test_pairs_of_the_texts_are_not_shuffled_to_find_phrases(spark, monkeypatch):
    words = [("x y x y z".split()), ("z x y".split()), (["z"],)[0], None, []]
    df = spark.createDataFrame(list(enumerate(words)), "d long, toks array<string>")
    # of unknown size, as the phrases of a corpus are
    found = spark.createDataFrame(spark.sparkContext.parallelize([("x", "y"), ("q", "r")]), "a string, b string")
    joined = tx.join_phrases(df, "d", "toks", found)
    assert "hashpartitioning(a#" not in joined._jdf.queryExecution().executedPlan().toString()
    want = {0: ["x_y", "x_y", "z"], 1: ["z", "x_y"], 2: ["z"], 3: None, 4: []}
    assert {r.d: r.toks for r in joined.collect()} == want
    monkeypatch.setattr(tx, "HASHES", 0)  # too many to hold: the planner decides
    assert {r.d: r.toks for r in tx.join_phrases(df, "d", "toks", found).collect()} == want
