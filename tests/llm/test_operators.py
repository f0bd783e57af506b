"""The operators on small tables against brute-force versions, and their results for unusual rows."""

import itertools
import math
import random
import re
import statistics
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from panelscore.llm import queries as llm_queries
from panelscore.llm import (chat, common, language, lm, mixing, passages, pieces, quality, search, simhash, toxicity)

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i}" for i in range(30_000))


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return common.session(spark).read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, columns with the operators' own names."""
    same = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \t\n ", None, None, 3), (None, "some text", "en", "a", 9),
            (5, same, "en", "a", 1), (6, same, "en", "b", 1), (7, LONG, "de", "b", 1), (7, LONG, "de", "b", 1),
            (8, "x", None, "a", None), (9, "...", "en", None, 1)]
    frame = common.session(spark).createDataFrame(rows, DOCS)
    return frame.select("*", *[F.lit(1).alias(c) for c in ("row", "kept", "size", "fp", "block", "shard", "score", "ids",
                                                          "spans", "words", "language", "id", "n")])


@pytest.fixture(scope="module")
def empty(spark):
    return common.session(spark).createDataFrame([], DOCS)


def low(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def texts(frame):
    return {r["doc_id"]: r["text"] for r in frame.select("doc_id", "text").collect()}


def roots(ids, links):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


# shared helpers

def test_components(spark):
    pairs = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 130)] + [(5, 5)]
    got = {r["node"]: r["component"] for r in common.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(1, 41)} | {i: 100 for i in range(100, 130)}


def test_components_of_nothing(spark):
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


# 1 SimHash

def brute_fingerprint(text):
    w = low(text)
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_matches_brute_force(docs):
    all_texts = texts(docs)
    prints = {i: brute_fingerprint(t) for i, t in all_texts.items()}
    want = roots(prints, [(a, b) for a, b in itertools.combinations(prints, 2)
                          if (prints[a] ^ prints[b]).bit_count() <= 4])
    rows = simhash.cluster(docs).collect()
    assert {r["doc_id"]: r["fp"] % 2 ** 64 for r in rows} == prints
    assert {r["doc_id"]: r["component_id"] for r in rows} == want


@pytest.mark.parametrize("blocks, node_leaves", [(5, 10), (6, 20_000), (5, 1)])
def test_trie_join_finds_every_link(spark, blocks, node_leaves):
    rng = np.random.default_rng(blocks * 7 + node_leaves)
    base = rng.integers(-2 ** 63, 2 ** 63, 12)
    near = [int(np.int64(np.bitwise_xor.reduce([np.int64(b), *(np.int64(np.uint64(1) << np.uint64(s)) for s in rng.choice(
        64, rng.integers(0, 6), replace=False))]))) for b in rng.choice(base, 150)]
    keys = sorted({*map(int, base), *near, 0, -1, 15})
    frame = spark.createDataFrame(list(enumerate(keys)), "id long, fp long")
    edges = [(r["a"], r["b"]) for r in simhash.link(frame, node_leaves, blocks).collect()]
    want = [(a, b) for a, b in itertools.combinations(range(len(keys)), 2)
            if ((keys[a] ^ keys[b]) % 2 ** 64).bit_count() <= 4]
    assert set(map(lambda e: (min(e), max(e)), edges)) <= {tuple(w) for w in roots_pairs(want, len(keys))}
    assert roots(range(len(keys)), edges) == roots(range(len(keys)), want)


def roots_pairs(links, n):
    of = roots(range(n), links)
    return [(a, b) for a, b in itertools.combinations(range(n), 2) if of[a] == of[b]]


def test_simhash_unusual_rows(odd, empty):
    got = {(r["doc_id"], r["component_id"]) for r in simhash.cluster(odd).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (None, None), (5, 5), (6, 5), (7, 7), (8, 8), (9, 9)}
    kept = simhash.one_of_each(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 5, 7, 7, 8, 9]
    assert simhash.cluster(empty).count() == 0 and simhash.one_of_each(empty).count() == 0


# 2 language

def held_out(frame, parts):
    return common.remainder(F.col("doc_id"), parts) == 2


def test_automaton_accepts_exactly_the_substrings():
    text = [0, 1, 2, 1, 2, 2, 0, 1, 1, 2]
    table = language.automaton(text, 3)
    inside = {tuple(text[i:j]) for i in range(len(text)) for j in range(i, len(text) + 1)}
    for n in (1, 2, 3, 4, 5):
        for word in itertools.product(range(3), repeat=n):
            state = ended = 0
            for c in word:
                entry = int(table[(state >> 1) + c])
                ended, state = ended | (entry & 1), entry
            assert (ended == 0) == (word in inside)


def test_phrases_match_greedy_parse():
    parser = language.CrossParser((("a", "the cat sat on the mat and the dog"), ("b", "le chat est sur la table")))
    for text in ("the cat and the table", "zzz", "la la la", "x" * 3000 + " the"):
        classes = parser.reduced(text)
        for k, (_, trained) in enumerate((("a", "the cat sat on the mat and the dog"), ("b", "le chat est sur la table"))):
            source = parser.reduced(trained).tolist()
            inside = {tuple(source[i:j]) for i in range(len(source)) for j in range(i + 1, len(source) + 1)}
            count = 0
            for at in range(0, len(classes), language.STRETCH):
                piece, i = classes[at:at + language.STRETCH].tolist(), 0
                while i < len(piece):
                    j = i + 1
                    while j < len(piece) and tuple(piece[i:j + 1]) in inside:
                        j += 1
                    i, count = j, count + 1
            assert parser.phrases([classes])[0, k] == count


def test_language_accuracy(spark, sf_dir, docs):
    rows = language.predict(docs, language.sample(docs, ~held_out(docs, 4))).where(held_out(docs, 4)).select(
        "lang", "language.*").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_unusual_rows(odd, empty):
    labelled = language.sample(odd, F.lit(True))
    got = language.predict(odd, labelled)
    und = {r["doc_id"] for r in got.where("language.lang_pred = 'und'").collect()}
    assert und == {1, 2, 3, 9} and set(odd.columns) - {"language"} <= set(got.columns)
    assert language.sample(empty, F.lit(True)) == {}
    assert {r[0] for r in language.predict(odd, {}).select("language.lang_pred").collect()} == {"und"}


def test_language_sample_is_bounded_by_rows_of_each_language(spark):
    rows = [(i % 50, f"{'ab'[i % 2] * 5}{i:04d}" * 40, "ab"[i % 2], None, 0) for i in range(400)] + [
        (1000 + i, "zz", f"l{i}", None, 0) for i in range(40)] + [(7, "ccccc" * 9, None, None, 0), (8, None, "a", None, 0)]
    frame = common.session(spark).createDataFrame(rows, DOCS)
    got = language.sample(frame, F.lit(True), rows=30, excerpt=100)
    assert set(got) == {"a", "b"} | {f"l{i}" for i in range(40)} and {got[f"l{i}"] for i in range(40)} == {"zz"}
    for k in "ab":
        pieces_ = got[k].split(" ")
        assert len(pieces_) == 30 and all(len(p) == 100 for p in pieces_)
        assert len({p[:9] for p in pieces_}) > 5  # from places all over the texts
    assert got == language.sample(frame.repartition(7), F.lit(True), rows=30, excerpt=100)


# 3 toxicity

def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        diagonal, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            diagonal, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, diagonal + (x != y))
    return row[-1]


def test_levenshtein_trie_matches_brute_force():
    terms = {t: 3.0 + i for i, t in enumerate(["idiot", "stupid", "moron", "trash", "maroon", "clown"])}
    lexicon = toxicity.Lexicon(terms, {})
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("idotmrnsa"), rng.integers(1, 8))) for _ in range(400)]
    for t in terms:
        words += [t, t[1:], t[:-1], t[:2] + "x" + t[2:], t[:2] + "x" + t[3:], t + "s", t[::-1], t[2:]]
    for w in words:
        near = [t for t in terms if distance(w, t) <= 1]
        assert lexicon.near(w) == (max(near, key=terms.get) if near else None), w


def test_toxicity_finds_planted_words(spark):
    plain = "the cat sat on the mat and you looked at nobody there for long"
    rows = [(i, plain + (f" {'idiot' if i % 2 else 'moron'}" if i % 4 == 0 or i % 5 == 0 else f" word{i}"))
            for i in range(200)]
    rows += [(1000, "what an idiott that man is, really and truly"), (1001, plain), (1002, ""), (1003, None)]
    frame = common.session(spark).createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0 or i % 5 == 0)) for i in range(200)], "doc_id long, toxic int")
    model = toxicity.fit(frame, labels)
    got = {r["doc_id"]: r["score"] for r in toxicity.score(frame, model).collect()}
    assert all((got[i] >= 0.3) == (i % 4 == 0 or i % 5 == 0) for i in range(200))
    assert got[1000] >= 0.3 > got[1001] and got[1002] == got[1003] < 0.3


def test_toxicity_unusual_rows(odd, empty, spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["score"] for r in toxicity.score(odd, toxicity.fit(odd, none)).collect()} == {0.0}
    one = spark.createDataFrame([(5, 1), (5, 0), (None, 1), (6, None)], "doc_id long, toxic int")
    assert {r["score"] for r in toxicity.score(odd, toxicity.fit(odd, one)).collect()} == {1.0}
    assert toxicity.score(empty, toxicity.fit(empty, one)).count() == 0


# 4 SentencePiece

def library():
    sentencepiece = pytest.importorskip("sentencepiece")
    return sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)


def test_pieces_match_the_library(docs):
    model = library()
    rows = pieces.encoded(docs).select("text", "ids", "n_tokens", "round_trip").collect()
    assert all(list(r["ids"]) == model.encode(r["text"]) and r["n_tokens"] == len(r["ids"]) for r in rows)
    assert all(r["round_trip"] for r in rows)


def test_pieces_of_strange_texts():
    model, coder = library(), pieces.Coder(pieces.read_model())
    rng = np.random.default_rng(5)
    cases = ["", " ", "  ", "a▁b", "x\0y", "é", "日本語𐍈", "①  ①", " " * 40 + "a", "\r\n\t", "ﬁ ", LONG]
    cases += ["".join(rng.choice(list("  abcdeé①hin\n日"), rng.integers(0, 40))) for _ in range(500)]
    got = [np.frombuffer(x, pieces.IDS).tolist() for x in coder.encode(cases)]
    assert got == model.encode(cases)
    assert [coder.decode(x) for x in got] == [c.replace("▁", " ") for c in cases]


def test_pieces_unusual_rows(odd, empty):
    got = {r["doc_id"]: r for r in pieces.encoded(odd).collect()}
    assert got[1]["ids"] is None and got[1]["n_tokens"] == 0 and got[2]["ids"] == []
    assert all(r["round_trip"] for i, r in got.items() if i != 1)
    assert pieces.encoded(empty).count() == 0


# 5 chat

def test_chat_links_and_orders(spark):
    calls = spark.createDataFrame([
        (1, 0, "a", "add", '{"y": 2, "x": 1}', None), (1, 1, "b", "add", '{"x": "1", "z": 0}', "a"),
        (1, 9, "c", "add", "[1]", None), (1, 10, None, "nop", None, None), (2, 0, "a", "add", '{"x":1}', "zz"),
        (1, 11, "d", "add", '{"x":1}', None), (1, 12, "d", "add", '{"x":1}', None)],
        "conv_id long, place long, call_id string, name string, arguments string, refers_to string")
    results = spark.createDataFrame([(1, 3, "a", "three"), (1, 5, "c", "early"), (1, 6, "q", None), (2, 1, "a", "x")],
                                    "conv_id long, place long, call_id string, content string")
    rows = chat.link(calls, results, {"add": {"x": ("integer", True), "y": ("integer", False)}}).collect()
    by = {(r["conv_id"], r["kind"], r["place"]): r for r in rows}
    assert by[1, "call", 0]["json"] == (
        '{"role":"assistant","tool_calls":[{"arguments":{"x":1,"y":2},"id":"a","name":"add"}]}')
    assert by[1, "call", 0]["errors"] == [] and by[1, "call", 0]["status"] == "linked"
    assert by[1, "call", 1]["errors"] == ["x is not integer", "unknown z"]
    assert by[1, "call", 9]["errors"] == ["not an object"] == by[1, "call", 10]["errors"]
    assert by[1, "call", 10]["status"] == "unanswered" and by[1, "call", 11]["status"] == "repeated"
    assert by[1, "result", 6]["status"] == "orphan" and by[1, "result", 6]["json"] == '{"role":"tool","tool_call_id":"q"}'
    order = {k: (r["sort_place"], r["level"], k[2]) for k, r in by.items()}
    assert order[1, "result", 5] > order[1, "call", 9]
    assert order[1, "call", 0] < order[1, "result", 3] < order[1, "call", 1]
    assert order[2, "call", 0] == (0, 0, 0)


def sorted_out(messages):
    """(sort_place, level) by following the references of each message one by one."""
    first = {}
    for conv, kind, call, place, to in sorted(messages, key=lambda m: (m[3], m[4] or "")):
        first.setdefault((conv, kind, call), (place, to))
    other = {"call": "result", "result": "call"}

    def target(conv, kind, to):
        key = (conv, other[kind], to)
        return key if to is not None and key in first else None

    def circular(key):
        seen, at = set(), key
        while at is not None and at not in seen:
            seen.add(at)
            at = target(at[0], at[1], first[at][1])
            if at == key:
                return True
        return False

    found = {}
    for conv, kind, call, place, to in messages:
        own, places = (conv, kind, call), [place]
        stop = circular(own) and first[own] == (place, to)
        at = None if stop else target(conv, kind, to)
        while at is not None:
            places.append(first[at][0])
            at = None if circular(at) else target(at[0], at[1], first[at][1])
        latest = max(places)
        found[conv, kind, call, place, to] = (latest, max(i for i, p in enumerate(places) if p == latest), stop)
    return found


CHAT = "conv_id long, kind string, call_id string, place long, refers_to string, status string"


def test_chat_chains_of_any_length_and_circles(spark):
    rng = random.Random(5)
    messages = [(1, "call", f"c{i}", 600 - 2 * i, f"c{i - 1}" if i else None) for i in range(300)]  # logged in reverse
    messages += [(1, "result", f"c{i}", 601 - 2 * i, f"c{i}") for i in range(300)]
    for conv in range(2, 30):  # random references: circles, tails that lead to them, repeated identifiers, no targets
        for place in range(40):
            kind = rng.choice(["call", "result"])
            call = f"c{rng.randrange(15)}"
            messages.append((conv, kind, call, place, call if kind == "result" else rng.choice([None, f"c{rng.randrange(17)}"])))
    frame = common.session(spark).createDataFrame([(*m, "linked") for m in messages], CHAT)
    want = sorted_out(messages)
    rows = chat.ordered(frame).collect()
    assert len(rows) == len(messages)
    for r in rows:
        got = (r["sort_place"], r["level"], r["status"] == "circular")
        assert got == want[r["conv_id"], r["kind"], r["call_id"], r["place"], r["refers_to"]]
    # the last result of the reversed chain follows the first result, 598 references away and latest of all
    assert max(r["level"] for r in rows) == 598 and any(r["status"] == "circular" for r in rows)


def test_chat_unusual_rows(spark):
    long = "x" * 300_000
    calls = common.session(spark).createDataFrame(
        [(None, 1, "a", "f", "{}", "a", 1), (1, None, "a", "f", "{}", None, 1), (1, 2, None, None, None, "a", 1),
         (1, 3, "b", "f", f'{{"x": "{long}"}}', "a", 1), (1, 3, "b", "f", f'{{"x": "{long}"}}', "a", 1)],
        "conv_id long, place long, call_id string, name string, arguments string, refers_to string, n_results int")
    results = spark.createDataFrame([(None, 0, "a", "r", 1, 1), (1, 1, None, None, 1, 1), (1, 1, "b", long, 1, 1)],
                                    "conv_id long, place long, call_id string, content string, level int, node int")
    rows = chat.link(calls, results, {"f": {"x": ("string", False)}}).collect()
    status = Counter((r["conv_id"], r["kind"], r["place"], r["status"], r["sort_place"]) for r in rows)
    assert status == Counter({(None, "call", 1, "unanswered", 1): 1, (1, "call", None, "unanswered", None): 1,
                              (1, "call", 2, "unanswered", 2): 1, (1, "call", 3, "repeated", 3): 2,
                              (None, "result", 0, "orphan", 0): 1, (1, "result", 1, "orphan", 1): 1,
                              (1, "result", 1, "repeated", 3): 1})
    assert sum(len(r["json"]) > 300_000 for r in rows) == 3


def test_chat_query_keeps_turns_without_keys(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    rows = [(None, 0, "user", "a"), (1, None, "user", None), (1, None, "assistant", "b"), (None, None, None, None),
            (1, 0, "user", "c"), (1, 1, "assistant", "d"), (1, 2, "user", None), (1, 2, "user", "e"), (1, 3, "assistant", None)]
    common.session(spark).createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(
        str(tmp_path / "conversations.parquet"))
    got = llm_queries.op5_chat(spark, str(tmp_path))
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW conversations AS FROM '{tmp_path}/conversations.parquet/*.parquet'")
    want = connection.execute(f"SELECT {', '.join(got.columns)} FROM ({llm_queries.OP5_SQL})").fetchall()
    assert Counter(map(tuple, got.collect())) == Counter(want) and len(want) == len(rows)


def test_chat_of_nothing(spark):
    calls = spark.createDataFrame([], "conv_id long, place long, call_id string, name string, arguments string, "
                                      "refers_to string")
    results = spark.createDataFrame([], "conv_id long, place long, call_id string, content string")
    assert chat.link(calls, results, {}).count() == 0


# 6 context-tree weighting

def test_base_scores_match_brute_force(docs):
    codes, words = lm.train(docs, ~held_out(docs, 7))
    rows = lm.score(docs, codes, words, docs.where(~held_out(docs, 7)).count()).collect()
    split = {i: low(t) for i, t in texts(docs).items()}
    known = [w for i, w in split.items() if zlib.crc32(str(i).encode()) % 7 != 2]
    counts = Counter(x for w in known for x in w)
    n, v = sum(counts.values()) + len(known), len(counts) + 1
    assert len(rows) == len(split)
    for r in rows:
        w = split[r["doc_id"]]
        base = sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w) + math.log10((len(known) + 1) / (n + v + 1))
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(w) + 1, 1 + sum(counts[x] > 0 for x in w), n)
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and r["score"] < 0


def brute_ctw(trained, text, depth):
    """Log10 probability of the text, node by node."""
    def decisions(t):
        padded = b"\n" * depth + t
        for i in range(depth, len(padded)):
            context, prefix = padded[i - depth:i][::-1], 1
            for place in range(8):
                bit = padded[i] >> (7 - place) & 1
                yield context, prefix, bit
                prefix = 2 * prefix + bit
    counts = Counter((c[:d], p, bit) for t in trained for c, p, bit in decisions(t) for d in range(depth + 1))
    nodes = {(c, p) for c, p, _ in counts}

    def own(node):
        a, b = counts[*node, 0], counts[*node, 1]
        return (math.lgamma(a + .5) + math.lgamma(b + .5) - 2 * math.lgamma(.5) - math.lgamma(a + b + 1))
    weighted, below = {}, {}
    for node in sorted(nodes, key=lambda x: -len(x[0])):
        if len(node[0]) == depth:
            weighted[node] = own(node)
        else:
            below[node] = sum(weighted[c, p] for c, p in nodes if p == node[1] and len(c) == len(node[0]) + 1
                              and c[:-1] == node[0])
            weighted[node] = np.logaddexp(own(node), below[node]) - math.log(2)
    total = 0.0
    for context, prefix, bit in decisions(text):
        p = None
        for d in range(depth, -1, -1):
            node = (context[:d], prefix)
            if node in nodes:
                a, b = counts[*node, 0], counts[*node, 1]
                here = (b + .5) / (a + b + 1)
                beta = None if p is None else math.exp(own(node) - below[node])
                p = here if p is None else (beta * here + p) / (1 + beta)
        p = .5 if p is None else p
        total += math.log10(p if bit else 1 - p)
    return total


def test_context_tree_matches_brute_force(spark):
    known = ["abracadabra abra", "the cat the mat", "", "cadabra"]
    rows = [(i, t) for i, t in enumerate([*known, "the abra", "zebra é", ""])]
    frame = common.session(spark).createDataFrame(rows, "doc_id long, text string")
    codes, words = lm.train(frame, F.col("doc_id") < 4)
    got = {r["doc_id"]: r["score"] for r in lm.score(frame, codes, words, 4).collect()}
    trained = [lm.normal(common.split_words(t)) for t in known]
    for i, t in rows:
        assert got[i] == pytest.approx(brute_ctw(trained, lm.normal(common.split_words(t)), lm.DEPTH), rel=1e-5)
    sharded = {r["doc_id"]: r["score"] for r in lm.score(frame, codes, words, 4, shard_runs=30).collect()}
    assert sharded == pytest.approx(got, rel=1e-5)


def test_lm_unusual_rows(odd, empty):
    codes, words = lm.train(odd, F.col("doc_id") != 8)
    rows = lm.score(odd, codes, words, 8).collect()
    assert sorted(r["doc_id"] or 0 for r in rows) == [0, 1, 2, 3, 5, 6, 7, 7, 8, 9]
    assert all(r["n_tokens"] == 1 for r in rows if r["doc_id"] in (1, 2, 3))
    codes, words = lm.train(odd, F.lit(None).cast("boolean"))
    assert {r["train_tokens"] for r in lm.score(odd, codes, words, 0).collect()} == {0}
    codes, words = lm.train(empty, F.lit(True))
    assert lm.score(empty, codes, words, 0).count() == 0


# 7 search

@pytest.mark.parametrize("with_self", [True, False])
def test_search_matches_brute_force(spark, with_self):
    rng = np.random.default_rng(11)
    codes = [*map(int, rng.integers(-2 ** 63, 2 ** 63, 300)), *([5] * 30), *([-1] * 3), 4, 7]
    rows = list(enumerate(codes))
    frame = spark.createDataFrame([*rows, (None, 5), (999, None)], "id long, code long")
    queries = frame.where("id % 20 = 0 or id = 320")
    got = {}
    for r in search.top_k(frame, queries, 7, with_self).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["distance"], r["id"])
    for q, code in rows:
        if q % 20 == 0:
            want = sorted((((code ^ c) % 2 ** 64).bit_count(), i) for i, c in rows if with_self or i != q)[:7]
            assert [got[q][k] for k in sorted(got[q])] == want


def test_search_of_few_and_none(spark):
    frame = spark.createDataFrame([(1, 5), (2, 6)], "id long, code long")
    assert search.top_k(frame, frame, 5).count() == 2
    assert search.top_k(frame.limit(0), frame, 5).count() == 0
    assert search.top_k(frame, frame.limit(0), 5).count() == 0


def test_search_never_broadcasts_look_ups(spark, monkeypatch):
    plans = []

    def staged(df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return common.stage(df, name)

    monkeypatch.setattr(search, "stage", staged)
    frame = spark.createDataFrame([(i, i * 0x9E3779B97F4A7C15 % 2 ** 63) for i in range(60)], "id long, code long")
    assert search.top_k(frame, frame.where("id < 5"), 3).count() == 15
    found = [plan for name, plan in plans if name == "search-found"]
    # a few queries, estimated small, have thousands of look-ups each
    assert found and not any("BroadcastExchange" in plan for plan in found)


@pytest.mark.parametrize("m", [8, 5, 4])
def test_search_rounds_cover_their_distance(m):
    rng, found = np.random.default_rng(m), search.rounds(m)
    bounds = [64 * i // m for i in range(m + 1)]
    assert found[-1][0] == 64 and [c for c, _ in found] == sorted({c for c, _ in found})
    for covered, radii in found:
        for _ in range(200):
            differ = rng.permutation(64) < covered  # any bits
            assert any(differ[low:high].sum() <= r for low, high, r in zip(bounds, bounds[1:], radii))


def test_search_of_far_queries(spark):
    rows = [(i, (1 << i % 20) - 1) for i in range(40)] + [(100, -1)]
    frame = spark.createDataFrame(rows, "id long, code long")
    got = search.top_k(frame, frame.where("id = 100"), 4).orderBy("rank").collect()
    assert [(r["id"], r["distance"]) for r in got] == [(19, 45), (39, 45), (18, 46), (38, 46)]


def test_sign_codes(spark):
    frame = spark.createDataFrame([([1.0, -1.0, 2.0],), ([],), ([None, 3.0],)], "v array<double>")
    assert [r[0] for r in frame.select(search.sign_code(F.col("v"))).collect()] == [5, 0, 2]


# 8 mixing

def shared_out(sizes, rate=1.5, repeats=2):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, free, got = rate * sum(sizes.values()), set(names), {}
    while free:
        unit = left / sum(weight[s] for s in free)
        full = [s for s in free if unit * weight[s] > repeats * sizes[s]]
        if not full:
            return got | {s: unit * weight[s] for s in free}
        for s in full:
            got[s] = repeats * sizes[s]
            left -= got[s]
            free.remove(s)
    return got


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100}, {"a": 10, "b": 1000, "c": 5, None: 300}, {"a": 0, "b": 7}, {"z": 1, "Z": 1, "é": 900},
    {"a": 0}])
def test_targets(spark, sizes):
    frame = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(frame).collect()}
    assert got == pytest.approx(shared_out(sizes))


def test_hypergeometric_follows_its_distribution(spark):
    frame = spark.range(4000).select(mixing.hypergeometric(
        F.lit(30).cast("long"), F.lit(12).cast("long"), F.lit(15).cast("long"), (F.col("id") + 0.5) / 4000).alias("x"))
    got = Counter(r["x"] for r in frame.collect())
    for x in range(0, 13):
        p = math.comb(12, x) * math.comb(18, 15 - x) / math.comb(30, 15)
        assert abs(got[x] / 4000 - p) < 0.001


def test_quotas_are_exact(spark):
    quotas = {1: 500, 2: 31, 3: 0, 4: 7}
    rows = mixing.split_quotas(spark.createDataFrame(list(quotas.items()), "number int, n long"), 3).collect()
    shards, sources = Counter(), Counter()
    for r in rows:
        shards[r["shard"]] += r["n"]
        sources[r["number"]] += r["n"]
    assert dict(sources) == quotas and max(shards.values()) - min(shards.values()) <= 1 and len(shards) == 8


def test_tree_is_dealt_over_tasks(spark):
    quotas = {1: 40_000, 2: 9_000, 3: 13}
    frame = spark.createDataFrame(list(quotas.items()), "number int, n long")
    split = mixing.split_quotas(frame, 8)
    assert split.rdd.getNumPartitions() > 8
    rows, shards, sources = split.collect(), Counter(), Counter()
    for r in rows:
        shards[r["shard"]] += r["n"]
        sources[r["number"]] += r["n"]
    assert dict(sources) == quotas and len(shards) == 256 and max(shards.values()) - min(shards.values()) <= 1


def test_draws_among_many_follow_the_distribution(spark):
    n = 20_000_000
    frame = spark.range(1, 10).select(mixing.hypergeometric(
        F.lit(2 * n).cast("long"), F.lit(n).cast("long"), F.lit(n).cast("long"), F.col("id") / 10).alias("x"))
    got, sd = sorted(r["x"] for r in frame.collect()), math.sqrt(n / 8)
    assert got == pytest.approx([n / 2 + sd * statistics.NormalDist().inv_cdf(u / 10) for u in range(1, 10)], abs=3)


def test_running_sums_match_one_window(spark):
    rows = [(i % 3, i, f"{(i * 7919) % 65536:04x}" if i % 5 else "00ff", i) for i in range(3000)]
    got = mixing._running(spark.createDataFrame(rows, "number int, block long, turn string, n long"), "turn", "n", "block")
    want, sums = {}, Counter()
    for number, block, turn, n in sorted(rows, key=lambda r: (r[0], r[2], r[1])):
        want[number, block] = sums[number]
        sums[number] += n
    assert {(r["number"], r["block"]): r["before"] for r in got.collect()} == want


def test_more_blocks_than_4096_and_many_shards(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MIN_SHARDS", 512)
    rows = spark.range(12_000).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.concat(F.lit("a b "), F.col("id")).alias("text"),
        F.when(F.col("id") % 2 == 0, F.lit("s")).alias("source"))
    dealt = mixing.deal(rows, block_docs=1).collect()
    shards = Counter(s for r in dealt for s in r["shards"])
    assert sum(r["taken"] for r in dealt) == pytest.approx(1.5 * 36_000, abs=2)
    assert len(shards) == 512 and max(shards.values()) < 60
    mixed = mixing.mix(rows, block_docs=1)
    want = Counter()
    for r in dealt:
        want[r["doc_id"] is None, r["source"]] += len(r["shards"])
    assert Counter((r["doc_id"] is None, r["source"]) for r in mixed.select("doc_id", "source").collect()) == want


def test_mix_meets_targets(docs):
    rows = mixing.deal(docs).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, mixing.deal(docs).collect()))
    taken, target = Counter(), {}
    for r in rows:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 2 * r["size"] and len(r["shards"]) == -(-r["taken"] // max(1, r["size"]))
    assert all(abs(taken[s] - t) <= 1 for s, t in target.items())
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    words = Counter()
    for r in mixed.collect():
        words[r["source"]] += len(WORD.findall(r["text"]))
    assert words == +taken


def test_mix_unusual_rows(odd, empty):
    rows = mixing.deal(odd).collect()
    assert len(rows) == 10 and sum(r["taken"] for r in rows) == pytest.approx(1.5 * sum(r["size"] for r in rows), abs=3)
    assert {r["size"] for r in rows if r["doc_id"] in (1, 2, 3)} == {0}
    mixed = mixing.mix(odd)
    assert mixed.columns == odd.columns and {r["row"] for r in mixed.collect()} == {1}
    want = Counter(r["doc_id"] for r in rows for _ in r["shards"])
    assert Counter(r["doc_id"] for r in mixed.collect()) == want and want[None] > 0
    assert mixing.deal(empty).count() == 0 and mixing.mix(empty).count() == 0


# 9 passages

@pytest.mark.parametrize("stack", [False, True])
def test_compact_windows_match_brute_force(stack):
    rng = np.random.default_rng(2)
    for n, kinds in ((60, 1000), (40, 4), (12, 1)):
        values = rng.integers(0, kinds, n).astype(np.uint64)
        make = passages._windows_by_stack if stack else passages.compact_windows
        got = set(make(values, 5))
        for i in range(n):
            for j in range(i + 4, n):
                at = i + int(values[i:j + 1].argmin())
                assert [1 for a, c, b in got if c == at and a <= i and j <= b] == [1]
                assert not [1 for a, c, b in got if c != at and a <= i <= c <= j <= b]


def test_passages_find_every_repeat(docs):
    split = {i: low(t) for i, t in texts(docs).items()}
    first, want = {}, {}
    for i in sorted(split):
        for a in range(len(split[i]) - 49):
            j = first.setdefault(tuple(split[i][a:a + 50]), i)
            if j != i:
                want.setdefault(i, set()).update(range(a, a + 50))
    rows = passages.cluster(docs).collect()
    assert len(rows) == len(split)
    found = {r["doc_id"]: {x for p in r["passages"] for x in range(p["start"], p["end"])} for r in rows}
    assert want and all(found[i] for i in want)
    assert sum(len(found[i] & w) for i, w in want.items()) >= 0.95 * sum(map(len, want.values()))
    for r in rows:
        assert r["repeated_words"] == len(found[r["doc_id"]]) and r["class_id"] <= r["doc_id"]
        for p in r["passages"]:  # every passage reported shares most of its five-word runs with the other document
            mine = {tuple(split[r["doc_id"]][x:x + 5]) for x in range(p["start"], p["end"] - 4)}
            other = {tuple(split[p["of"]][x:x + 5]) for x in range(len(split[p["of"]]) - 4)}
            assert len(mine & other) >= 0.8 * len(mine)


def test_changed_passages_and_cutting(spark):
    rng = np.random.default_rng(4)
    word = [f"t{x}" for x in rng.integers(0, 5000, 5000)]
    shared = word[:120]
    changed = shared[:60] + ["other"] + shared[61:]
    rows = [(1, " ".join(word[200:260] + shared + word[300:350])), (2, "Head one.\n" + " ".join(changed) + " tail two"),
            (3, " ".join(shared)), (4, " ".join(word[1000:1100])), (5, " ".join(word[2000:2020] + shared[:30]))]
    frame = common.session(spark).createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in passages.cluster(frame).collect()}
    assert [got[i]["class_id"] for i in range(1, 6)] == [1, 1, 1, 4, 5]
    assert got[2]["repeated_words"] >= 100 and got[3]["repeated_words"] >= 120 - 2 * 9
    left = texts(passages.without_repeats(frame))
    assert left[1] == rows[0][1] and left[4] == rows[3][1] and len(left[3].split()) <= 18
    assert left[2].startswith("Head one.\n") and left[2].endswith("tail two") and len(left[2].split()) < 30


def test_changed_passages_without_long_runs(spark):
    rng = np.random.default_rng(6)
    shapes, times, rows, at = ((55, 1), (60, 1), (80, 1), (120, 2), (200, 4)), 40, [], {}
    for size, changes in shapes:
        for _ in range(times):
            shared = [f"s{x}" for x in rng.integers(0, 10**9, size)]
            other = list(shared)
            for k in range(changes):
                other[size * (k + 1) // (changes + 1)] = f"c{rng.integers(0, 10**9)}"
            for words in (shared, other):
                context = [f"w{x}" for x in rng.integers(0, 10**9, 300)]
                rows.append((len(rows), " ".join(context[:150] + words + context[150:])))
            at[len(rows) - 1] = (size, changes)
    frame = common.session(spark).createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r for r in passages.cluster(frame).collect()}
    for shape in shapes:
        found = [i for i, s in at.items() if s == shape and got[i]["class_id"] == i - 1
                 and got[i]["repeated_words"] >= 0.95 * shape[0]]
        assert len(found) >= 0.9 * times, shape
    for i in at:  # contexts are of random words
        assert all(150 <= p["start"] and p["end"] <= 150 + at[i][0] for p in got[i]["passages"])


def test_long_run_leaves_what_follows(spark):
    rng = np.random.default_rng(7)
    rows, own = [], {}
    for _ in range(20):  # a shared header, and a form with one own word in every 20
        head, form = ([f"s{x}" for x in rng.integers(0, 10**9, n)] for n in (60, 200))
        for _ in range(2):
            filled = list(form)
            for k in range(10, 200, 20):
                filled[k] = f"o{rng.integers(0, 10**9)}"
            own[len(rows)] = [w for w in filled if w[0] == "o"]
            rows.append((len(rows), " ".join(head + filled)))
    tail = [f"t{x}" for x in rng.integers(0, 10**9, 121)]  # changed once, 90 words behind the start and 30 from the end
    rows += [(100, " ".join(tail)), (101, " ".join([*tail[:90], "other", *tail[91:]]))]
    frame = common.session(spark).createDataFrame(rows, "doc_id long, text string").repartition(4)
    left = texts(passages.without_repeats(frame))
    for i, mine in own.items():
        gone = set(mine) - set(left[i].split())
        assert len(gone) <= i % 2
        assert i % 2 == 0 or len(left[i].split()) <= 200
    assert left[100] == rows[-2][1] and 101 not in left


@pytest.mark.parametrize("phrases", [1, 30])
def test_passages_that_the_smallest_document_of_a_block_lacks(spark, phrases):
    """two documents share a changed passage; each half of it is also in smaller documents, in texts of their own."""
    rng = np.random.default_rng(8)
    rows, pairs = [], []

    def within(words):
        context = [f"w{x}" for x in rng.integers(0, 10**9, 200)]
        rows.append((len(rows), " ".join(context[:100] + words + context[100:])))
        return len(rows) - 1

    for _ in range(12):
        passage = [f"s{x}" for x in rng.integers(0, 10**9, 50)]
        for _ in range(phrases):
            alone = [within(passage[:25]), within(passage[26:])]
        pairs.append((within(passage), within(passage[:25] + ["changed"] + passage[26:]), alone))
    frame = common.session(spark).createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r for r in passages.cluster(frame).collect()}
    for one, two, alone in pairs:
        assert got[two]["class_id"] == one and got[one]["class_id"] == one
        assert [(p["start"], p["end"], p["of"]) for p in got[two]["passages"]] == [(100, 150, one)]
        assert all(got[i]["class_id"] == i for i in alone)


def test_minima_are_those_of_the_compact_windows():
    rng = np.random.default_rng(9)
    batch = passages.Batch(list(range(30)), [" ".join(f"w{x}" for x in rng.integers(0, 30 if i % 5 == 0 else 10**6, 20 * i))
                                             for i in range(30)])
    _, at, _, wide = batch.minima()
    values = np.maximum(passages._mixed(batch.hashed.tokens() + np.uint64(0x632BE59BD9B4E019)), np.uint64(1))
    for least, found in ((passages.RUN, at), (passages.TOKENS, at[wide])):
        assert set(found.tolist()) == {
            low + minimum for low, high in zip(batch.starts.tolist(), batch.ends.tolist())
            for _, minimum, _ in passages.compact_windows(values[low:high - passages.SHINGLE + 1], least)}


def test_documents_of_one_class_are_not_paired(spark, monkeypatch):
    rng, real, staged = np.random.default_rng(9), passages.stage, {}

    def stage(df, name):
        staged.setdefault(name, []).append(real(df, name))
        return staged[name][-1]

    monkeypatch.setattr(passages, "stage", stage)
    monkeypatch.setattr(passages, "discard", lambda df: None)
    # the smallest document of the block repeats the word too seldom to be linked to the others
    some = lambda: " ".join(f"w{x}" for x in rng.integers(0, 10**9, 60))
    rows = [(i, f"{some()} {' '.join(['of'] * (60 if i else 30))} {some()}") for i in range(41)]
    got = {r["doc_id"]: r for r in passages.cluster(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0]["class_id"] == 0 and all(got[i]["class_id"] == 1 for i in range(1, 41))
    assert all(got[i]["repeated_words"] == 60 for i in range(2, 41))
    assert sum(df.count() for name in ("passages-nearest", "passages-others") for df in staged.get(name, [])) <= 2 * 41


def test_passages_unusual_rows(odd, empty):
    rows = passages.cluster(odd).collect()
    assert sorted(r["doc_id"] or 0 for r in rows) == [0, 1, 2, 3, 5, 6, 7, 7, 8, 9]
    assert all(r["n_links"] == 0 and r["class_id"] == r["doc_id"] for r in rows)
    kept = passages.without_repeats(odd)
    assert kept.columns == odd.columns and kept.count() == 10
    assert passages.cluster(empty).count() == 0 and passages.without_repeats(empty).count() == 0


# 10 quality

def brute_base(text):
    w = WORD.findall(text or "")
    grams = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if grams[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    n, repeated = len(w), len(covered)
    return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), repeated,
            n < 20 or 100 * repeated > 30 * n)


def test_quality_matches_brute_force(spark, sf_dir, docs):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    ratios = quality.fit(docs, quality.trusted_ids(labels))
    rows = {r["doc_id"]: r for r in quality.measure(docs, ratios).drop("row").collect()}
    hashes = {r[0]: r[1] for r in docs.select(F.explode(common.words(F.col("text"))).alias("w")).distinct().select(
        "w", F.xxhash64("w")).collect()}
    for i, text in texts(docs).items():
        r = rows[i]
        got = tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"))
        assert got == brute_base(text)
        assert r["kept"] == (not r["base_failed"] and r["ratio"] >= quality.THRESHOLD)
    one = next(i for i, t in texts(docs).items() if 30 < len(WORD.findall(t)) < 90)
    w = [hashes[x] for x in WORD.findall(texts(docs)[one])]
    pairs = spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(zip(w, [*w[1:], None]))], "k int, a long, b long")
    buckets = [x % quality.BUCKETS for x in w] + [r[0] % quality.BUCKETS for r in pairs.orderBy("k").select(
        F.xxhash64("a", "b")).collect()]
    assert rows[one]["ratio"] == pytest.approx(sum(ratios[b] for b in buckets) / len(buckets), abs=1e-5)
    kept = quality.kept_documents(docs, quality.trusted_ids(labels))
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, r in rows.items() if r["kept"]}


def test_quality_keeps_good_documents(spark, sf_dir, docs):
    good = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1")
    ratios = quality.fit(docs, good.select("doc_id"))
    rows = quality.measure(docs, ratios).join(good, "doc_id").where("not base_failed").collect()
    assert all(r["kept"] for r in rows)


def test_quality_unusual_rows(odd, empty, spark):
    none = spark.createDataFrame([], "doc_id long")
    rows = quality.measure(odd, quality.fit(odd, none)).collect()
    assert len(rows) == 10 and {r["doc_id"] for r in rows if r["kept"]} == {7}
    assert quality.kept_documents(odd, none).columns == odd.columns
    assert quality.kept_documents(empty, none).count() == 0


def test_pairs_of_pieces_stay_apart_as_their_characters_merge():
    coder = pieces.Coder(pieces.read_model())
    n = len(coder.pieces)
    random = np.random.default_rng(3)
    cut = random.integers(0, len(coder.join_keys), 3000)
    left = np.r_[random.integers(0, n, 2000), coder.join_keys[cut] // n, random.integers(0, 500, 2000)]
    right = np.r_[random.integers(0, n, 2000), coder.join_keys[cut] % n, random.integers(0, 500, 2000)]
    want = [coder.merged(coder.pieces[a] + coder.pieces[b]) == [coder.pieces[a], coder.pieces[b]]
            for a, b in zip(left.tolist(), right.tolist())]
    assert coder.unmerged(left, right).tolist() == want and True in want and False in want


def test_pieces_of_equal_score_merge_from_the_left():
    scores = {"▁": -9, "a": -9, "b": -9, "aa": -1, "ab": -1, "ba": -2, "aab": -2, "bb": -3, "aaa": -3, "aba": -4, "aaaa": -5}
    coder = pieces.Coder(tuple((p, float(s), 0) for p, s in scores.items()))
    grid = np.array([(a, b) for a in range(len(coder.pieces)) for b in range(len(coder.pieces))])
    want = [coder.merged(coder.pieces[a] + coder.pieces[b]) == [coder.pieces[a], coder.pieces[b]] for a, b in grid.tolist()]
    assert coder.unmerged(grid[:, 0], grid[:, 1]).tolist() == want


def test_a_long_word_costs_no_memory_for_the_short_ones():
    import tracemalloc
    coder = pieces.Coder(pieces.read_model())
    words = sorted({f"w{i}" for i in range(4000)} | {"xq7" * 3000})
    tracemalloc.start()
    coder.learn(words)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 << 20
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    assert [np.frombuffer(i, pieces.IDS).tolist() for i in coder.encode(words[-3:])] == [model.encode(w) for w in words[-3:]]


def test_words_share_what_no_piece_joins(monkeypatch):
    import sentencepiece
    coder, searched = pieces.Coder(pieces.read_model()), []
    edges = coder.edges
    monkeypatch.setattr(coder, "edges", lambda text: searched.append(len(text)) or edges(text))
    marks = [".", ",", "&&&", "###", ".\n", "$$$", "日", ""]
    texts = [" ".join(f"thinouat{a}{b}{m}" for a in "abcdefghij" for b in "klmnopqrst") for m in marks]
    texts += ["", " ", "  ", "日  a", "  日 ", "x\0 \0"]
    model = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    assert [np.frombuffer(i, pieces.IDS).tolist() for i in coder.encode(texts)] == [model.encode(t) for t in texts]
    assert sum(searched) < sum(map(len, texts)) / 4
