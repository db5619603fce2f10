"""Chat formatting, spelling variants and the prefix trie against brute force, and their odd cases."""

import hashlib
import json
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from parity import compare, connect
from weirflow.llm import chat_format, prefix_trie, registry, spelling

SF = "/root/testdata/sf0.001"
TURNS = "conv_id long, turn long, role string, text string, id string, at string, node string, n long"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- chat formatting -------------------------------------------------------------------------

TEMPLATE = chat_format.Template()


def hostile_texts():
    rng = random.Random(8)
    parts = [*chat_format.CONTROLS, "\x10", "0;", "1;", "12;", "<", "|", ">", "im_start", "[", "]", "/INST", "\n", "é", "😀", "a", "\\", "\x00", '"']
    return ["".join(rng.choices(parts, k=rng.randrange(8))) for _ in range(400)] + ["", "\x10" * 5, "x" * 300_000]


def test_escapes_are_reversible_and_leave_no_control_string(spark):
    texts = hostile_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "i long, t string")
    out = df.select("i", TEMPLATE.inside(F.col("t")).alias("e"), TEMPLATE.inside(F.col("t"), "\n").alias("r")).select(
        "*", TEMPLATE.outside(F.col("e")).alias("back"), TEMPLATE.outside(F.col("r"), "\n").alias("role")).collect()
    for r in out:
        assert r.back == r.role == texts[r.i]
        assert not any(c in r.e for c in chat_format.CONTROLS) and "\n" not in r.r


def test_marks_that_could_be_taken_for_escapes_are_refused():
    for bad in ("1x", ";", "a\x10", ""):
        with pytest.raises(ValueError):
            chat_format.Template(controls=(*chat_format.CONTROLS, bad))
    with pytest.raises(ValueError):
        chat_format.Template(open="<turn>")


RECORDS = {
    "messages": ({"messages": [{"role": "user", "content": "a"}, {"content": None, "role": "assistant"}], "id": 7}, [("user", "a"), ("assistant", "")]),
    "from and value": ({"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}, {"from": "judge", "value": "c"}], "system": "s"},
                       [("system", "s"), ("user", "a"), ("assistant", "b"), ("judge", "c")]),
    "instruction": ({"instruction": "do", "input": "this", "output": ""}, [("user", "do\n\nthis"), ("assistant", "")]),
    "instruction with history": ({"history": [["a", "b"], ["c", "d"]], "output": "f", "instruction": "e"},
                                 [("user", "a"), ("assistant", "b"), ("user", "c"), ("assistant", "d"), ("user", "e"), ("assistant", "f")]),
    "prompt and completion": ({"completion": "b", "prompt": "a"}, [("user", "a"), ("assistant", "b")]),
    "prompt and response": ({"prompt": "a", "response": "b", "context": ""}, [("user", "a"), ("assistant", "b")]),
    "question and answer": ({"question": "a", "answer": "b", "context": "c"}, [("user", "a\n\nc"), ("assistant", "b")]),
    "no messages": ({"messages": [], "id": "x"}, None),
}


def test_layouts_are_told_by_their_fields(spark):
    odd = {"text": "plain"}, {"instruction": "a"}, {"messages": [{"role": "user"}]}, {"prompt": {"text": "a"}, "completion": "b"}
    rows = [(k, json.dumps(r), "kept") for k, (r, _) in RECORDS.items()]
    rows += [(f"odd{i}", json.dumps(r), "kept") for i, r in enumerate(odd)] + [("null", None, "kept"), ("broken", '{"prompt": ', "kept")]
    out = {r.k: r for r in chat_format.convert(spark.createDataFrame(rows, "k string, record string, layouts string"), "record").collect()}
    for name, (_, turns) in RECORDS.items():
        if turns is not None:
            assert out[name].layout == name and [tuple(t) for t in out[name].turns] == turns
    for name in ("odd0", "odd1", "odd2", "odd3"):
        assert out[name].layout is None and out[name].turns is None and out[name].fingerprint is not None
    for name in ("null", "broken"):
        assert out[name].layout is None and out[name].fingerprint is None
    assert all(r.layouts == "kept" for r in out.values())
    paths = spark.createDataFrame([('{"b": [{"x": 1, "y": [[2]]}, {"z": {"q": null}}], "a": {}, "c": []}',)], "t string").select(
        chat_format.field_paths(F.parse_json("t"))).first()[0]
    assert paths == ["a", "b[].x", "b[].y[][]", "b[].z.q", "c"]


def formatted_rows(spark, rows):
    df = spark.createDataFrame([(*r, "i", "x", "n", 1) for r in rows], TURNS)
    return chat_format.read_back(chat_format.format_records(chat_format.packed(df), "conv_id", "record"))


def test_formatted_conversations_read_back(spark):
    texts = hostile_texts()
    rng = random.Random(2)
    rows = []
    for conv in range(60):
        roles = rng.choice([["user", "assistant"], ["system", "user", "assistant"], ["user", "assistant"] * 4, ["user"] * 3,
                            ["human", "assistant"], ["tool\n", "<|im_end|>", "assistant", ""], ["assistant"]])
        rows += [(conv, k, r, rng.choice(texts)) for k, r in enumerate(roles)]
    rows += [(100, None, "user", "first"), (100, 0, None, None), (100, 0, "assistant", "tie b"), (100, 0, "assistant", "tie a"), (100, 0, "assistant", "tie a"),
             (None, 1, "assistant", "no id"), (101, 3, "assistant", None)]
    want = defaultdict(list)
    for conv, turn, role, text in rows:
        want[conv].append((turn is not None, turn or 0, role or "", text or ""))
    got = {r.conv_id: r for r in formatted_rows(spark, rows).collect()}
    assert set(got) == set(want)
    for conv, turns in want.items():
        own = [(r, t) for _, _, r, t in sorted(turns)]
        assert [tuple(t) for t in got[conv].turns] == own and got[conv].n_turns == len(own)
        assert list(got[conv].learned) == [t for r, t in own if r == "assistant"]
        text = got[conv].formatted
        assert text.count(TEMPLATE.open) == text.count(TEMPLATE.close) == len(own)
        under = [text[m.start : m.start + m.length] for m in got[conv].loss_mask]
        assert all(text[m.start + m.length :].startswith(TEMPLATE.close) for m in got[conv].loss_mask)
        assert not any(c in u for u in under for c in chat_format.CONTROLS)
    assert chat_format.read_back(chat_format.format_records(
        chat_format.packed(spark.createDataFrame([], TURNS)), "conv_id", "record")).count() == 0


def test_conversations_equal_sql_and_run_natively(spark):
    df = registry.op11_chat_format(spark, SF)
    ok, note = compare(df, connect(SF), registry.OP11_SQL)
    assert ok, note
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
    rows = registry.conversations(spark, SF).select("conv_id", "turn", "role", "text")
    layouts = chat_format.convert(chat_format.packed(rows), "record").groupBy("layout").count().collect()
    assert len(layouts) >= 3 and all(r.layout for r in layouts)


# --- spelling --------------------------------------------------------------------------------

LETTERS = re.compile("[A-Za-zÀ-ÿ]+")


def counted(docs, misspell=None):
    out = Counter()
    for doc_id, text in docs:
        for run in LETTERS.findall(text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if misspell and h % misspell == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= 6:
                out[run] += 1
    return out


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def grouped(counts):
    words = {w: n for w, n in counts.items() if n >= 5}
    rows = {}
    for w, n in words.items():
        others = sorted((-m, v) for v, m in words.items() if near(w, v))
        best = others[0] if others and -others[0][0] >= 5 * n else None
        rows[w] = (best and best[1], n, len(others), best and -best[0])
    out = set()
    for w, (form, n, many, form_n) in rows.items():
        root = w
        while rows[root][0]:
            root = rows[root][0]
        out.add((w, form, root, n, many, form_n))
    return out


@pytest.fixture(scope="module")
def misspelt():
    rng = random.Random(4)
    stems = ["".join(rng.choices("abcdeéÀ×ÿ", k=rng.randrange(5, 9))) for _ in range(30)]
    texts = []
    for k in range(120):
        words = []
        for _ in range(60):
            w = list(rng.choice(stems[: 1 + int(30 * rng.random() ** 2)]))
            if rng.random() < 0.3:
                at = rng.randrange(len(w))
                w[at : at + 1] = rng.choice([[], [rng.choice("abé")], [w[at], w[at]]])
            words.append("".join(w).upper() if rng.random() < 0.1 else "".join(w))
        texts.append((k, rng.choice([" ", ", ", "1", "\n", "Ā", "—"]).join(words)))
    texts += [(200, None), (201, ""), (202, "a" * 40), (203, "b" * 7), (204, "b" * 8), (None, "caféscafés cafés"), (5, texts[5][1]), (205, "zz " * 30)]
    return texts + [(300 + k, ("x" * 70 + " ") * 5 + ("x" * 71 + " ") * 25 + ("x" * 40 + "y" * 30 + " ") * 5) for k in range(2)]


@pytest.mark.parametrize("misspell", [None, 7])
def test_variants_equal_brute_force(spark, misspelt, misspell, monkeypatch):
    monkeypatch.setattr(spelling, "HELD", 100)
    docs = spark.createDataFrame([(k, t, "w", 3, "r") for k, t in misspelt], "doc_id long, text string, word string, n long, root string").repartition(3)
    counts = spelling.word_counts(docs, misspell=misspell)
    want = counted(misspelt, misspell)
    assert {(r.word, r.n) for r in counts.collect()} == set(want.items())
    got = [tuple(r) for r in spelling.group_variants(counts).collect()]
    assert len(got) == len(set(got)) and set(got) == grouped(want)
    assert sum(r[4] > 0 for r in got) > 30 and len({r[2] for r in got if r[2] != r[0]}) > 3


def test_forms_lead_to_a_root_over_several_steps(spark):
    words = ["aaaaaa", "aaaaab", "aaaabb", "aaabbb", "aabbbb", "abbbbb", "bbbbbb"]
    counts = {w: 5 * 5**k for k, w in enumerate(words)} | {"cccccc": 5, "cccccd": 24, "tied-a": 30, "none": 4}
    got = {tuple(r) for r in spelling.group_variants(spark.createDataFrame(list(counts.items()), "word string, n long")).collect()}
    assert got == grouped(counts) and {r[2] for r in got if r[0] in words} == {"bbbbbb"}


def test_filters_in_many_slices_and_passes_find_the_same(spark, misspelt, monkeypatch):
    want = counted(misspelt)
    counts = spark.createDataFrame(list(want.items()), "word string, n long")
    monkeypatch.setattr(spelling, "SLICE", 2)
    monkeypatch.setattr(spelling, "PASS_SLICES", 3)
    assert {tuple(r) for r in spelling.group_variants(counts).collect()} == grouped(want)


def test_filters_hold_all_words_and_few_others():
    rng = np.random.default_rng(0)
    words = sorted({"".join(map(chr, rng.integers(97, 123, 9))) for _ in range(3000)})
    blocks = -(-len(words) * spelling.KEY_BITS // 64)
    bits = np.zeros(blocks, np.uint64)
    hashes = {w: None for w in words}
    for at, codes in spelling._by_length(words):
        h = spelling._final((codes * spelling._powers(9)[:9]).sum(1, dtype=np.uint64), 9)
        for k in range(spelling._PROBES):
            np.bitwise_or.at(bits, spelling._blocks(h, blocks), np.uint64(1) << spelling._bit(h, k))
        hashes.update(zip([words[i] for i in at], h.tolist()))
    found = spelling.Filters({9: blocks}, {(9, 0): bits.tobytes()})
    known = np.array(list(hashes.values()), np.uint64)
    assert len(found.positive(known, 9)) == len(words) and not len(found.positive(known, 8))
    others = rng.integers(0, 2**63, 200_000).astype(np.uint64)
    assert len(found.positive(others, 9)) < 0.01 * len(others)


def test_no_words(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.group_variants(spelling.word_counts(empty, misspell=199)).count() == 0


def test_spelling_equals_sql(spark):
    ok, note = compare(registry.op12_spelling_variants(spark, SF), connect(SF), registry.OP12_SQL)
    assert ok, note


def test_long_texts_are_cut_between_runs(spark, monkeypatch):
    monkeypatch.setattr(spelling, "CUT", 50)
    text = "éclairé wörter-" * 40 + "x" * 400 + " tailed"
    got = spelling.word_counts(spark.createDataFrame([(1, text)], "doc_id long, text string"))
    assert {(r.word, r.n) for r in got.collect()} == set(counted([(1, text)]).items())


# --- the prefix trie -------------------------------------------------------------------------


def brute_trie(conversations):
    """{node: row} of {conv: [(role, text)]}."""
    members = defaultdict(list)
    for conv, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
    rows = []
    for node, convs in members.items():
        below = [m for m in members if m[: len(node)] == node]
        children = [m for m in below if len(m) == len(node) + 1]
        leaves = [m for m in below if not any(len(x) == len(m) + 1 and x[: len(m)] == m for x in below)]
        saved = sum((len(members[m]) - 1) * (len(m[-1][1]) if m else 0) for m in below)
        ends = sorted(c for c in convs if len(conversations[c]) == len(node))
        rows.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children), len(leaves), saved,
                     sha(",".join(map(str, ends)))))
    return sorted(rows, key=str)


def rebuilt(rows, heads=True):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(x)] for c, x in own.items()}
    if not heads:
        return own
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    return out


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


@pytest.fixture(scope="module")
def talks():
    rng = random.Random(6)
    rows = []
    for conv in [*range(100, 160), *range(300, 340), *range(405, 420)]:
        n = rng.randrange(1, 7)
        rows += [(conv, k, "user" if k % 2 == 0 else "assistant", rng.choice(["hello", "same", "é" * 5, f"own {conv}"])) for k in range(n)]
    rows += [(500, k, "user", f"deep {k}") for k in range(300)]
    rows += [(700, None, "user", "first"), (700, 0, None, None), (700, 0, "user", "b"), (700, 0, "user", "b"), (None, 0, "user", "nobody's"), (701, 5, "", "")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "i", "x", "n", 1) for r in rows], TURNS)


@pytest.mark.parametrize("heads", [True, False])
def test_trie_equals_brute_force(spark, talks, heads, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SIBLINGS", 7)
    own = prefix_trie.digests(frame(spark, talks))
    turns, ids = prefix_trie.with_shared_heads(own) if heads else (own, own.select("conv").distinct())
    # so few arcs at the end that the rounds do nearly all of the ranking
    out = prefix_trie.trie(turns, ids, finish=40)
    want = brute_trie(rebuilt(talks, heads))
    assert sorted((tuple(r) for r in out.select(COLUMNS).collect()), key=str) == want
    spans = out.select("first_arc", "last_arc", "n_convs").collect()
    assert sorted(x for r in spans for x in r[:2]) == list(range(2 * len(want)))
    assert all(r.first_arc < r.last_arc for r in spans)


def test_trie_of_copies_and_of_nothing(spark):
    rows = [(c, k, "user", "x" * (k + 1)) for c in range(1, 51) for k in range(3)]
    out = prefix_trie.conversation_trie(frame(spark, rows)).select(COLUMNS).collect()
    assert sorted((tuple(r) for r in out), key=str) == brute_trie(rebuilt(rows, False))
    assert prefix_trie.conversation_trie(frame(spark, [])).count() == 0
    assert prefix_trie.conversation_trie(frame(spark, [(None, 1, "user", "x")])).count() == 0


def test_trie_equals_sql(spark):
    ok, note = compare(registry.op13_prefix_trie(spark, SF), connect(SF), registry.OP13_SQL)
    assert ok, note
