"""Joins, passages and benchmark windows against brute force, and their odd cases."""

import random
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from weirflow.llm import arrowtext, decontamination, ngram_join, passages

UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SCHEMA = "doc_id long, text string, n long, set_id string, token string, row string, _id long"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(3000)]
    line = " ".join(rng.choices(vocabulary, k=13))
    shared = " ".join(rng.choices(vocabulary, k=51))
    base = rng.choices(vocabulary, k=150)
    out = [None, "", " \t\n", "One", "one", "one two three", "One two THREE", " ".join(["same"] * 400)]
    for k in range(12):  # near copies, a few edits each
        copy = list(base)
        for _ in range(k // 3):
            copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
        out.append(" ".join(copy))
    out += [" ".join(base), " ".join(base).upper()]
    for _ in range(10):  # a common line in texts that have nothing else in common
        out.append(line + "\n" + " ".join(rng.choices(vocabulary, k=rng.randrange(5, 60))))
    for k in (0, 7, 40):  # a passage of 51 words somewhere
        out.append(" ".join(rng.choices(vocabulary, k=k)) + " " + shared + " " + " ".join(rng.choices(vocabulary, k=60 - k)))
    out.append(" ".join(rng.choices(vocabulary, k=20_000)))
    return out


@pytest.fixture
def docs(spark, texts):
    rows = [(k, t, None, "x", None, "r", 7) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows + [(8, texts[8], 1, None, None, None, None), (None, "no id", 1, "", "", "", 1)], SCHEMA)


def shingle_classes(texts):
    sets = {}
    for k, text in enumerate(texts):
        w = words(text)
        sets[k] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    parent = {k: k for k in sets}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 80 * len(sets[a] | sets[b]):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {(k, len(s), root(k)) for k, s in sets.items()}


def test_link_classes(docs, texts):
    got = [tuple(r) for r in ngram_join.link_classes(docs).collect()]
    assert len(got) == len(texts) + 2
    assert set(got) - {(None, None, None)} == shingle_classes(texts)
    assert (None, None, None) in got and sum(r[0] == 8 for r in got) == 2


def test_more_text_has_more_partitions(docs, texts, monkeypatch):
    few = arrowtext.parts_of(docs)
    spans = {tuple(r) for r in passages.repeated_passages(docs).collect()}
    monkeypatch.setattr(arrowtext, "PART_BYTES", 300)
    size = sum(len((r.text or "").encode()) for r in docs.collect())
    assert arrowtext.parts_of(docs) == -(-size // 300) > few
    monkeypatch.setattr(arrowtext, "PART_BYTES", 2_000)
    assert arrowtext.parts_of(docs) > few
    got = {tuple(r) for r in ngram_join.link_classes(docs).collect()}
    assert got - {(None, None, None)} == shingle_classes(texts)
    assert {tuple(r) for r in passages.repeated_passages(docs).collect()} == spans


def test_one_of_each(docs, texts):
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    want = {k for k, _, c in shingle_classes(texts) if k == c} | {None}
    assert {r.doc_id for r in kept.collect()} == want


def test_one_id_on_several_texts_loses_no_text(spark, texts):
    one, two, three = texts[8], "alpha beta gamma delta epsilon zeta eta", "ab cd ef"
    rows = [(3, one), (5, one), (5, two), (9, two), (9, two), (5, None), (5, None), (7, three), (7, three), (None, two)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(((r.doc_id, r.text) for r in ngram_join.one_of_each(docs).collect()), key=str)
    assert kept == sorted([(3, one), (5, two), (5, None), (5, None), (7, three), (None, two)], key=str)


def test_clean_rows_stay_beside_contaminated_ones_of_their_id(spark):
    item = " ".join(f"b{k}" for k in range(13))
    bench = spark.createDataFrame([("i", item)], "item_id string, text string")
    rows = [(1, f"x {item} y"), (1, "all is well"), (None, item), (None, "fine"), (2, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {(r.doc_id, r.text) for r in decontamination.clean_documents(docs, bench).collect()}
    assert kept == {(1, "all is well"), (None, "fine"), (2, None)}


def test_few_clean_windows_pass_a_large_benchmark(spark):
    """The bitmap grows with the benchmark: what is joined stays little, and the result is exact."""
    rng = random.Random(9)
    vocabulary = [f"v{k}" for k in range(20_000)]
    items = [(f"i{k}", " ".join(rng.choices(vocabulary, k=100))) for k in range(2_000)]
    bench = spark.createDataFrame(items, "item_id string, text string")
    docs = [(k, " ".join(rng.choices(vocabulary, k=400))) for k in range(200)]
    docs += [(1000 + k, docs[k][1] + " " + " ".join(items[k][1].split()[20:40])) for k in range(20)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    windows = decontamination.benchmark_windows(bench).cache()
    _, slots, widths = decontamination._bitmap(windows)
    assert widths == [13] and slots >= 32 * windows.count() / 2 and slots > decontamination.LEAST_SLOTS
    scanned = decontamination._scanned(frame, windows, "doc_id", "text")
    passed = scanned.selectExpr("sum(size(places)) AS n", "sum(n_words) AS words").first()
    assert passed.n - 20 * 8 < 0.01 * passed.words
    found = {r.doc_id: (r.n_hit, r["items"]) for r in decontamination.contamination(frame, bench).collect()}
    assert found == {k: (20, [f"i{k - 1000}"]) if k >= 1000 else (0, []) for k, _ in docs}
    windows.unpersist()


def test_no_documents(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert ngram_join.link_classes(empty).count() == 0
    assert passages.repeated_passages(empty).count() == 0
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.contamination(empty, bench).count() == 0


def test_centres_and_rest_find_the_same(docs, texts, monkeypatch):
    monkeypatch.setattr(ngram_join, "ROUNDS", 1)
    monkeypatch.setattr(ngram_join, "CENTRES", 1)
    got = {tuple(r) for r in ngram_join.link_classes(docs).collect()} - {(None, None, None)}
    assert got == shingle_classes(texts)


def test_compact_windows():
    rng = np.random.default_rng(1)
    for _ in range(60):
        n, least = int(rng.integers(3, 60)), int(rng.integers(1, 6))
        values = rng.integers(1, 12, n).astype(np.uint64) << np.uint64(40)
        stops = np.sort(rng.choice(n, 2, replace=False))
        got = set(zip(*[x.tolist() for x in passages.compact_windows(values, stops, least)]))
        want = set()
        for m in set(range(n)) - set(stops.tolist()):
            a = b = m
            while a > 0 and a - 1 not in stops and values[a - 1] > values[m]:
                a -= 1
            while b + 1 < n and b + 1 not in stops and values[b + 1] >= values[m]:
                b += 1
            if b - a + 1 >= least:
                want.add((m, m - a, b - m))
        assert got == want


def test_passages(docs, texts):
    got = passages.repeated_passages(docs).collect()
    covered = {}
    for r in got:
        covered.setdefault(r.doc_id, set()).update(range(r.first, r.last + 1))
    seen = {}
    for k, text in enumerate(texts):
        w = words(text)
        for i in range(len(w) - 49):
            seen.setdefault(tuple(w[i : i + 50]), set()).add((k, i))
    for places in seen.values():
        if len({k for k, _ in places}) > 1:
            assert all(set(range(i, i + 50)) <= covered.get(k, set()) for k, i in places)
    clean = [k for k, t in enumerate(texts) if k >= 22 and t and len(words(t)) != 111]
    assert not set(clean) & set(covered)
    assert all(r.class_id <= r.doc_id for r in got)


def passage_classes(got):
    """Words covered and classes of each document."""
    covered, classes = {}, {}
    for r in got:
        covered.setdefault(r.doc_id, set()).update(range(r.first, r.last + 1))
        classes.setdefault(r.doc_id, set()).add(r.class_id)
    return covered, classes


def test_passages_beside_a_part(spark):
    """The smallest id holds only part of a passage that later documents hold whole."""
    rng = random.Random(11)
    some = lambda n: [f"v{rng.randrange(10**9)}" for _ in range(n)]
    rows, places = [], {}
    for t in range(40):
        shared, part = some(51 + t % 10), 35 + t % 12
        at = rng.randrange(len(shared) - part + 1)
        k = rng.randrange(60, 200)
        rows.append((t, " ".join(some(k) + shared[at : at + part] + some(200))))
        for doc in (1000 + t, 2000 + t):
            k = rng.randrange(300)
            rows.append((doc, " ".join(some(k) + shared + some(300 - k))))
            places[doc] = (k, k + len(shared))
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    covered, classes = passage_classes(got)
    assert all(set(range(*place)) <= covered.get(doc, set()) for doc, place in places.items())
    assert all(len(covered[doc]) <= (b - a) * 1.25 for doc, (a, b) in places.items())
    assert all(classes[1000 + t] == classes[2000 + t] and len(classes[1000 + t]) == 1 for t in range(40))


@pytest.mark.parametrize("changes", [0, 2])
def test_passages_of_groups_of_copies(spark, changes):
    """Two groups of exact copies share a passage, exactly or nearly; their classes meet."""
    rng = random.Random(12)
    some = lambda n: [f"v{rng.randrange(10**9)}" for _ in range(n)]
    rows = []
    for t in range(30):
        shared = some(60 if not changes else 300)
        for group in (0, 1):
            own = list(shared)
            for _ in range(changes * group):
                own[rng.randrange(len(own))] = "other"
            text = " ".join(some(rng.randrange(10, 200)) + own + some(rng.randrange(10, 200)))
            rows += [(1000 * copy + 2 * t + group, text) for copy in range(3)]
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    covered, classes = passage_classes(got)
    assert len(classes) == len(rows)
    assert all(classes[doc] == {doc % 1000 // 2 * 2} for doc, _ in rows)


def test_alike_stretches():
    rng = np.random.default_rng(2)
    similar = lambda a, b: len(set(a) & set(b)) / len(set(a) | set(b))
    seen = set()
    for _ in range(80):
        a = rng.permutation(1000)[:22]
        b = np.concatenate((2000 + rng.permutation(1000)[:4], a[rng.integers(0, 6) : rng.integers(14, 22)], 3000 + rng.permutation(1000)[:4]))
        for _ in range(rng.integers(0, 7)):
            k = rng.integers(0, len(b))
            b = np.delete(b, k) if rng.random() < 0.5 else np.insert(b, k, 4000 + rng.integers(1000))
        cuts = lambda x: [x[i : j + 1].tolist() for i in range(len(x)) for j in range(i + 8 - 1, len(x))]
        want = any(similar(x, y) >= 0.8 for x in cuts(a) for y in cuts(b))
        got = passages.alike_stretches(a.astype(np.uint32), b.astype(np.uint32), 80, 8)
        assert bool(got) == want
        assert all(similar(a[i : j + 1], b[k : m + 1]) >= 0.79 and min(j - i, m - k) >= 7 for i, j, k, m in got)
        seen.add(want)
    assert seen == {True, False}


def near_recall(spark, n, changes, texts=100):
    """Share of the near passages, in texts that have nothing else in common, found in both texts."""
    rng = random.Random(3)
    some = lambda n: [f"v{rng.randrange(10**9)}" for _ in range(n)]
    rows, places = [], {}
    for t in range(texts):
        shared = some(n)
        for group in (0, 1):
            own = list(shared)
            for k in range(changes * group):
                own[(k + 1) * n // (changes + 1)] = "other"
            k = rng.randrange(300)
            rows.append((1000 * group + t, " ".join(some(k) + own + some(300 - k))))
            places[1000 * group + t] = (k, k + n)
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    covered, _ = passage_classes(got)
    assert all(k >= a - 60 and k < b + 60 for doc, (a, b) in places.items() for k in covered.get(doc, ()))
    hit = lambda doc: len(covered.get(doc, set()) & set(range(*places[doc]))) >= 0.9 * n
    return sum(hit(t) and hit(1000 + t) for t in range(texts)) / texts


def test_near_passages(spark):
    """No run of 50 words is whole in either of them."""
    assert near_recall(spark, 80, 1) >= 0.95
    assert near_recall(spark, 150, 3) >= 0.95


def test_near_passages_of_the_least_length(spark):
    """The similarity is just reached, so that every hash is needed."""
    assert near_recall(spark, 50, 1, 200) >= 0.95


def test_near_passages_of_later_documents_only(spark):
    """Earlier documents hold the middle of a passage, too little to be alike, that later ones hold nearly whole."""
    rng = random.Random(17)
    some = lambda n: [f"v{rng.randrange(10**9)}" for _ in range(n)]
    middle = some(40)
    rows = [(k, " ".join(some(rng.randrange(60, 90)) + middle + some(80))) for k in range(6)]
    places = {}
    for t in range(40):
        passage = some(12) + middle + some(12)
        for group in (1, 2):
            own = list(passage)
            if group == 2:
                own[8 if t % 2 else 55] = "other"
            k = rng.randrange(200)
            rows.append((1000 * group + t, " ".join(some(k) + own + some(200 - k))))
            places[1000 * group + t] = (k, k + len(own))
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    covered, classes = passage_classes(got)
    assert all(set(range(a + 12, b - 12)) <= covered.get(doc, set()) for doc, (a, b) in places.items())
    assert all(classes[1000 + t] & classes[2000 + t] for t in range(40))
    assert not set(range(6)) & set(covered)


def test_equal_stretches():
    """Found whatever the tokens are, repeated ones too."""
    rng = np.random.default_rng(4)
    for _ in range(60):
        a, b = (rng.integers(0, 3, 60).astype(np.uint32) for _ in "ab")
        k = rng.integers(0, 40)
        b[10:25] = a[k : k + 15]
        held = {b[i : i + 8].tobytes() for i in range(len(b) - 7)}
        want = {j for i in range(len(a) - 7) if a[i : i + 8].tobytes() in held for j in range(i, i + 8)}
        got = passages.equal_stretches(a, b, 8)
        assert {j for first, last in got for j in range(first, last + 1)} == want and got == sorted(got)


def test_memberships_are_spread():
    """Blocks of different batches don't meet in one group."""
    cut = ngram_join._cut(16, 5)
    batches = [ngram_join.pa.RecordBatch.from_arrays(
        [ngram_join.pa.array([1000 * k + i for i in range(20)]), ngram_join.pa.array([f"one two three four five six {i}" for i in range(20)])],
        names=["doc", "text"]) for k in range(200)]
    groups, docs = {}, set()
    for out in cut(iter(batches)):
        for fragment, ids in zip(out.column(0).to_pylist(), out.column(1).to_pylist()):
            if fragment < 0:
                groups[fragment] = groups.get(fragment, 0) + 1
                docs |= set(np.frombuffer(ids, np.int64).tolist())
    assert docs == {1000 * k + i for k in range(200) for i in range(20)}
    assert len(groups) == 16 and max(groups.values()) < 40 and min(groups) >= -16


def brute_contamination(texts, items):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(UPPER))
    out = {}
    for k, text in texts:
        w, hit, found = cut(text), set(), set()
        for item, body in items:
            b = cut(body)
            n = min(13, len(b))
            for win in {tuple(b[i : i + n]) for i in range(len(b) - n + 1)} if n else ():
                for i in range(len(w) - n + 1):
                    if tuple(w[i : i + n]) == win:
                        hit.update(range(i, i + n))
                        found.add(str(item))
        out[k] = (len(w), len(hit), sorted(found))
    return out


def test_contamination(spark):
    item = "alpha Beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi"
    items = [(1, item), (10, "Short one"), (2, None), (3, "..."), (4, item + " omicron")]
    rows = [
        (0, None), (1, ""), (2, "say: " + item.upper() + "!"), (3, "a short, one b " + "z " * 100), (4, item.replace("mu", "my")),
        (5, "SHORT-ONE"), (6, " ".join(["É" + item, item, "filler"] * 3)), (7, "é " * 30_000 + item), (7, "another row"),
    ]
    docs = spark.createDataFrame([(k, t, 1, "w") for k, t in rows], "doc_id long, text string, n_words int, item string")
    bench = spark.createDataFrame([(k, t, "c") for k, t in items], "item_id long, text string, width string")
    got = decontamination.contamination(docs, bench)
    assert got.columns == ["doc_id", "n_words", "n_hit", "items", "spans"]
    by = sorted((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in got.collect())
    want = sorted((k, *brute_contamination([(k, t)], items)[k]) for k, t in rows)
    assert by == want
    kept = decontamination.clean_documents(docs, bench)
    bad = {k for k, n, hit, _ in want if hit and 20 * hit >= n}
    assert {r.doc_id for r in kept.collect()} == {k for k, _ in rows} - bad and kept.columns == docs.columns
    cut = {r.doc_id: r.text for r in decontamination.cut_spans(docs, bench).collect() if r.doc_id in (0, 2, 4)}
    assert cut[0] is None and cut[4] == item.replace("mu", "my") and "ALPHA" not in cut[2] and cut[2].startswith("say: ")
    none = spark.createDataFrame([], "item_id long, text string")
    assert {r.n_hit for r in decontamination.contamination(docs, none).collect()} == {0}


def _pairs_of(batches) -> set:
    met = [b for b in batches if b.column(0)[0].as_py() != passages._MANY]
    cells = [(np.frombuffer(b.column(1)[i].as_py(), np.int64), np.frombuffer(b.column(2)[i].as_py(), np.int64)) for b in met for i in range(b.num_rows)]
    return {p for x, c in cells for p in zip(x.tolist(), c.tolist())}


def test_pairs_of_a_run_that_many_hold():
    n = 300
    blobs = [np.arange(n, dtype=np.int64), np.arange(n, dtype=np.int32), np.full(n, 7, np.uint64)]
    batch = pa.RecordBatch.from_arrays([pa.array([0]), *[pa.array([v.tobytes()], pa.binary()) for v in blobs]], names=passages._DEALT.names)
    stars = list(passages._stars(4)(iter([batch])))
    assert _pairs_of(stars) == {(0, i) for i in range(1, n)}
    many = pa.Table.from_batches([b for b in stars if b.column(0)[0].as_py() == passages._MANY])
    held = pa.Table.from_batches(passages._stretches(iter(many.to_batches())))
    assert held.column("doc").to_pylist() == list(range(1, n))


def test_pairs_that_are_not_settled():
    ids, classes, settled = np.arange(1, 13), np.array([1] * 5 + [6] * 5 + [1, 12]), np.array([True] * 10 + [False] * 2)
    columns = [np.full(12, 7), ids, np.arange(12), np.arange(12) + 15, classes, settled]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[*passages._HELD.names, "class", "settled"])
    wanted = {(a, b) for a in range(1, 13) for b in range(a + 1, 13) if b > 10 or (a <= 5 < b)}
    assert _pairs_of(passages._unsettled(4)(iter([batch]))) == wanted
    some = _pairs_of(passages._unsettled(4, 3)(iter([batch])))
    assert some < wanted and {x for p in some for x in p} >= {11, 12}


def test_likely_stretches():
    rng = np.random.default_rng(5)
    for _ in range(200):
        places = np.flatnonzero(rng.random(40) < rng.choice([0.5, 0.8, 0.95]))
        held = set()
        for i, s in enumerate(places):
            for j in range(i, len(places)):
                n, length = j - i + 1, places[j] - s + 1
                if 180 * n >= 160 * 8 and 100 * n >= 80 * length:
                    held |= set(range(s, places[j] + 1))
        got = set()
        for first, last in passages.likely_stretches(places, 80, 8):
            got |= set(range(first, last + 1))
        assert got >= held and (bool(got) == bool(held))
