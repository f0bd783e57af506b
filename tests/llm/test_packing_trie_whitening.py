"""Packing, prefix trie and whitening against brute-force versions, and their results for unusual rows."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelscore.llm import common, packing, prefixes, queries, whitening

public_tokenizers = pytest.importorskip("public_tokenizers")
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def brute_ids(text):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(TOKENIZER).encode(text or "", add_special_tokens=False).ids + [1]


def check_places(rows, tokens, most_pieces=None, most_attention=None):
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= tokens
        assert len(parts) <= (most_pieces or tokens)
        assert sum(n * n for _, n in parts) <= (most_attention or tokens ** 2)
    return len(by_sequence)


def test_packing_matches_the_tokenizer(spark, sf_dir):
    common.session(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = packing.pack(docs, TOKENIZER, tokens=1000).collect()
    found = defaultdict(dict)
    for r in rows:
        ids = np.frombuffer(bytes(r["ids"]), "<u4").tolist()
        assert len(ids) == r["length"] and r["start"] == 1000 * r["piece"]
        found[r["doc_id"]][r["piece"]] = ids
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(TOKENIZER)
    for doc, text in texts.items():
        want = whole.encode(text or "", add_special_tokens=False).ids + [1]
        assert [t for k in sorted(found[doc]) for t in found[doc][k]] == want
        assert all(len(ids) == 1000 for k, ids in found[doc].items() if k < max(found[doc]))
    n = check_places(rows, 1000)
    least = sum(r["length"] for r in rows) / 1000
    assert n <= 1.02 * least + 1


def test_packing_query_digests(spark, sf_dir):
    rows = queries.op11_packing(spark, sf_dir).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    check_places(rows, 4096)
    for r in rows[::40]:
        ids = brute_ids(texts[r["doc_id"]])[r["start"]:r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())


def test_words_of_strange_texts():
    words = packing._words(open(TOKENIZER, encoding="utf-8").read())
    for text in ["", " \t\n", "it's I'll 12a-b", "a\x1cb\x85c\xa0d e", "x<|endoftext|>y <|startoftext|>", "É é ́x",
                 "ΑΣ ΟΔΟΣ", "漢字 かな", "😀👍🏽", "a" * 5000, "\r\n\x0b\x0cx", "tab\tTAB", "İX ÀÉß's Ǆ ǅx ×÷ ½² ŸœŒ'LL ɏȺ don't DON'T",
                 "".join(map(chr, range(0x21, 0x250))), " ".join(map(chr, range(0x21, 0x2AF))), "<|endoftext|>É"]:
        assert np.frombuffer(words.encode(text.encode()), "<u4").tolist() == brute_ids(text)[:-1], text


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_best_fit_holds_every_capacity(rule):
    random.seed(1)
    length = np.array([random.choice([1, 3, 10, 30, 64, 100]) for _ in range(600)])
    sizes = np.stack([length, np.ones_like(length), length ** 2], axis=1)
    capacity = np.array([100, 6, 6000])
    sizes = sizes[(sizes <= capacity).all(axis=1)]
    bins = packing.best_fit(sizes, capacity, np.ones(3), rule)
    for b in range(bins.max() + 1):
        assert (sizes[bins == b].sum(axis=0) <= capacity).all() and (bins == b).any()
    # the rule by itself, item by item
    free, found = [], np.empty(len(sizes), int)
    for i in np.argsort(-(sizes / capacity) @ np.ones(3), kind="stable"):
        room = [b for b, f in enumerate(free) if (f >= sizes[i]).all()]
        if room:
            score = {b: (((free[b] - sizes[i]) / capacity) ** 2).sum() if rule == "norm"
                     else -(free[b] * sizes[i] / capacity.astype(float) ** 2).sum() for b in room}
            b = min(room, key=lambda b: score[b])
            assert score[b] <= min(score.values()) + 1e-12
        else:
            b = len(free)
            free.append(capacity.copy())
        free[b] = free[b] - sizes[i]
        found[i] = b
    assert abs(len(free) - (bins.max() + 1)) <= 1


def test_best_fit_of_too_large_and_none():
    with pytest.raises(ValueError):
        packing.best_fit(np.array([[101, 1, 1]]), np.array([100, 9, 9]), np.ones(3))
    assert len(packing.best_fit(np.empty((0, 3), int), np.array([100, 9, 9]), np.ones(3))) == 0


def test_packing_over_groups_and_capacities(spark):
    common.session(spark)
    rows = spark.range(3000).select(F.lit(7).alias("doc_id"), F.lit("x").alias("__other"),
                                    (F.col("id") % 97 + 1).alias("length"))
    placed = packing.place(rows, tokens=400, most_pieces=12, most_attention=30_000, group=256).collect()
    assert len(placed) == 3000 and placed[0]["__other"] == "x"
    n = check_places(placed, 400, 12, 30_000)
    assert n <= 1.1 * sum(r["length"] for r in placed) / 400 + 2


def test_packing_unusual_rows(spark):
    common.session(spark)
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(1, None), (None, "some text"), (2, ""), (3, " \n "), (4, long), (4, long), (4, "x"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select(
        "*", *[F.lit(1).alias(c) for c in ("piece", "ids", "length", "sequence_id", "offset", "__group")])
    placed = packing.pack(docs, TOKENIZER).collect()
    assert check_places(placed, 4096) >= 1
    empty_ids = [r["doc_id"] for r in placed if r["length"] == 1 and r["piece"] == 0]
    assert sorted(i for i in empty_ids if i is not None) == [1, 2, 3] and None in empty_ids
    want = -(-len(brute_ids(long)) // 4096)
    assert sum(r["doc_id"] == 4 for r in placed) == 2 * want + 1
    assert packing.pack(docs.where("false"), TOKENIZER).count() == 0


def brute_trie(convs):
    """{prefix: row} from {conv: [(digest, chars)]}."""
    members, ends = defaultdict(set), defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].add(c)
        ends[tuple(turns)].append(c)
    kids = defaultdict(set)
    for p in members:
        if p:
            kids[p[:-1]].add(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) if kids[p] else 1
        saved[p] = (len(members[p]) - 1) * (p[-1][1] if p else 0) + sum(saved[k] for k in kids[p])
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, m in members.items())


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def found_trie(turns, convs, **options):
    rows = prefixes.trie(turns, convs, **options).select(*COLUMNS).collect()
    return sorted(map(tuple, rows), key=lambda r: [(x is not None, x) for x in r])


def as_sorted(rows):
    return sorted(rows, key=lambda r: [(x is not None, x) for x in r])


@pytest.mark.parametrize("letters, most, batches", [(2, 9, 3), (1, 40, 2)])
def test_trie_matches_brute_force(spark, letters, most, batches):
    common.session(spark)
    random.seed(letters)
    texts = {c: [random.choice("abc"[:letters]) * random.choice([1, 1, 1, 2]) for _ in range(random.randint(0, most))]
             for c in range(120)}
    for c in range(60, 90):  # long shared beginnings
        texts[c] = texts[c % 7] + texts[c]
    rows = [(c, t, "user", x) for c, xs in texts.items() for t, x in enumerate(xs)]
    turns = prefixes.symbols(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    convs = spark.createDataFrame([(c,) for c in texts], "conv long")
    want = brute_trie({c: [(x, len(x)) for x in xs] for c, xs in texts.items()})
    assert found_trie(turns, convs, batches=batches) == as_sorted(want)


def test_signatures_across_partitions(spark):
    common.session(spark)
    rows = spark.range(3000).select(F.explode(F.sequence(F.lit(1).cast("long"), F.lit(3).cast("long"))).alias("conv_id"),
                                    F.col("id").alias("turn"), F.lit("user").alias("role"), (F.col("id") % 5).cast("string").alias("text"))
    more = rows.unionByName(spark.createDataFrame([(4, 0, "user", "0"), (4, 1, "user", "9")], rows.schema))
    found = prefixes.signed(prefixes.symbols(more)).collect()
    at = {(r["conv"], r["depth"]): r for r in found}
    assert len(at) == 9002
    for d in range(1, 3001):
        assert at[1, d]["p"] == at[2, d]["p"] == at[3, d]["p"] and at[1, d]["c"] == d
        assert at[2, d]["prev"] == (at[2, d - 1]["p"] if d > 1 else prefixes.ROOT)
    assert at[4, 1]["p"] == at[1, 1]["p"] and at[4, 2]["p"] != at[1, 2]["p"]
    assert len({bytes(r["p"]) for r in found}) == 3001


def test_two_fattest(spark):
    rows = spark.range(0, 40).crossJoin(spark.range(1, 41).withColumnRenamed("id", "high")).where("id < high").select(
        "id", "high", prefixes._fattest("id", "high").alias("f")).collect()
    for r in rows:
        assert r["f"] == max(range(r["id"] + 1, r["high"] + 1), key=lambda x: x & -x)


def test_digests_of_many_ends(spark):
    common.session(spark)
    ends = spark.range(0, 20_000, 3).select(F.col("id").alias("conv"), F.when(F.col("id") < 9, prefixes.ROOT).otherwise(
        F.lit(b"x" * 16)).alias("p"))
    found = {bytes(r["p"]): r["sha"] for r in prefixes.digests(ends).collect()}
    assert found[prefixes.ROOT] == hashlib.sha256(b"0,3,6").hexdigest()
    assert found[b"x" * 16] == hashlib.sha256(",".join(map(str, range(9, 20_000, 3))).encode()).hexdigest()


def test_trie_unusual_rows(spark):
    common.session(spark)
    rows = [(7, None, None, None), (7, 1, "user", "x"), (7, 1, "user", "x"), (8, None, "", ""), (8, 1, "user", "x"),
            (None, 1, "user", "x"), (9, 2, "a", "b" * 100_000), (10, 5, "ab", ""), (11, 5, "a", "b")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").select(
        "*", *[F.lit(1).alias(c) for c in ("conv", "p", "depth", "digest", "chars", "edge")])
    turns = prefixes.symbols(frame)
    convs = turns.select("conv").distinct()
    want = brute_trie({7: [("0", 0), ("x", 1), ("x", 1)], 8: [("0", 0), ("x", 1)], 9: [("b", 100_000)], 10: [("ab:", 0)],
                       11: [("a:b", 1)]})
    assert found_trie(turns, convs) == as_sorted(want)
    assert found_trie(turns.where("false"), convs.where("false"), batches=1) == []
    alone = found_trie(turns.where("false"), convs.where("conv = 7"), batches=1)
    assert alone == [(7, 0, None, 1, 0, 1, 0, hashlib.sha256(b"7").hexdigest())]


def test_rebuilt_conversations(spark):
    common.session(spark)
    texts = {c: [f"{c}-{t}" for t in range(n)] for c, n in [(0, 3), (1, 4), (2, 1), (3, 9), (105, 2), (200, 8), (250, 7)]}
    rows = [(c, t, "user", x) for c, xs in texts.items() for t, x in enumerate(xs)]
    turns = prefixes.symbols(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    made, convs = prefixes.rebuilt(turns)
    want = {}
    for c, xs in texts.items():
        h = zlib.crc32(str(c).encode()) % 6
        want[c] = texts.get(c - c % 100, [])[:h] + xs[h:]
    assert found_trie(made, convs) == as_sorted(brute_trie({c: [(x, len(x)) for x in xs] for c, xs in want.items()}))


def check_whitening(rows, vectors, components=4):
    x = np.floor(256 * np.array(list(vectors.values()), float))
    fit = np.unique(x, axis=0)
    n, centred = len(fit), fit - fit.mean(0)
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    made = {(r["vec_id"], r["component"]): r for r in rows}
    assert len(made) == len(vectors) * min(components, x.shape[1])
    sums = [sum(int(v) for v in fit[:, i]) for i in range(x.shape[1])]
    for k in range(min(components, x.shape[1])):
        got = np.array([made[v, k + 1]["whitened"] for v in vectors], float)
        want = (x - fit.mean(0)) @ axes[:, k] / np.sqrt(values[k])
        assert min(abs(got - want).max(), abs(got + want).max()) < 1e-8
    for v, row in zip(vectors, x):
        r = made[v, 1]
        assert r["n"] == n and r["deviation"] == sum((n * int(a) - s) ** 2 for a, s in zip(row, sums))
        assert abs(r["explained"] - values[0] / values.sum()) < 1e-9 and r["identity_error"] < 1e-9


def test_whitening_matches_numpy(spark, sf_dir):
    rows = queries.op13_whitening(spark, sf_dir).collect()
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    check_whitening(rows, {r["vec_id"]: r["embedding"] for r in table})


def test_characteristic_polynomial(spark):
    common.session(spark)
    random.seed(5)
    a = [[random.randint(-50, 50) for _ in range(6)] for _ in range(9)]
    matrix = [[sum(r[i] * r[j] for r in a) for j in range(6)] for i in range(6)]
    poly = whitening.characteristic(spark, matrix)
    for x in range(-3, 4):  # det(x - matrix) by fractions
        from fractions import Fraction
        m = [[Fraction((x if i == j else 0) - matrix[i][j]) for j in range(6)] for i in range(6)]
        det = Fraction(1)
        for k in range(6):
            det *= m[k][k]
            for i in range(k + 1, 6):
                f = m[i][k] / m[k][k]
                m[i] = [u - f * v for u, v in zip(m[i], m[k])]
        assert sum(c * x ** k for k, c in enumerate(poly)) == det
    roots = whitening.largest_roots(poly, 6, 40)
    assert np.allclose(np.array(roots, float) / 2 ** 40, np.linalg.eigvalsh(np.array(matrix, float))[::-1])
    assert whitening.roots_above([-6, 11, -6, 1], 1) == 2  # (x - 1)(x - 2)(x - 3)


def test_hessenberg_of_sparse_matrices():
    for m in ([[0, 0, 2], [0, 5, 0], [2, 0, 0]], [[0] * 4] * 4, [[1]], [[0, 3, 0, 0], [0, 0, 0, 4], [5, 0, 0, 0], [0, 0, 6, 0]]):
        p = 2_147_483_647
        want = [round(c) % p for c in np.poly(np.array(m, float))[::-1]]
        assert [int(c) for c in whitening.characteristic_modulo(np.array(m), p)] == want


def test_whitening_of_repeated_roots(spark):
    """Equal variance in every direction: any orthogonal directions do, but they must be orthogonal."""
    common.session(spark)
    rows = [(2 * i + s, [float((1 - 2 * s) * (i == j)) for j in range(5)]) for i in range(5) for s in (0, 1)]
    found = whitening.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert len(found) == 40 and max(r["identity_error"] for r in found) < 1e-12
    assert all(abs(r["explained"] - 0.2) < 1e-12 for r in found)


def test_whitening_unusual_rows(spark):
    common.session(spark)
    nan, inf = float("nan"), float("inf")
    good = {1: [0.5, 1.0, -2.0], 2: [0.25, -1.0, 2.0], 3: [-0.5, 0.0, 1.0], 4: [3.0, 0.1, 0.3], 5: [0.5, 1.0, -2.0]}
    bad = [(6, None), (7, []), (8, [1.0, None, 2.0]), (9, [1.0, nan, 2.0]), (10, [inf, 1.0, 1.0]), (11, [1.0, 2.0]), (12, [1e300, 1.0, 1.0])]
    frame = spark.createDataFrame([*good.items(), *bad, (None, good[1])], "vec_id long, embedding array<double>")
    frame = frame.select("*", *[F.lit(1).alias(c) for c in ("x", "n", "component", "whitened")])
    rows = whitening.whitened(frame).collect()
    assert sum(r["vec_id"] is None for r in rows) == 3
    check_whitening([r for r in rows if r["vec_id"] is not None], good)
    assert whitening.whitened(frame.where("vec_id > 5")).count() == 2 * 1  # the pair of numbers alone, without variance
    assert whitening.whitened(frame.where("false")).count() == 0
    same = whitening.whitened(frame.where("vec_id = 1")).collect()
    assert [(r["whitened"], r["explained"], r["deviation"], r["identity_error"]) for r in same] == [(None, 0.0, 0, 0.0)] * 3


def test_scatter_of_large_entries(spark):
    common.session(spark)
    rows = [(1, [1e16, -1e15]), (2, [-1e16, 3e15]), (3, [5e15, 2e15])]
    frame = whitening.fixed_point(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    n, sums, matrix = whitening.scatter(frame.select("x"), 2)
    x = [[int(v * 256) for v in r[1]] for r in rows]
    assert (n, sums) == (3, [sum(r[i] for r in x) for i in range(2)])
    assert matrix == [[3 * sum(r[i] * r[j] for r in x) - sums[i] * sums[j] for j in range(2)] for i in range(2)]


def test_known_words_are_bounded():
    """What a worker remembers fits the memory of an executor that runs several."""
    words = packing.Words(open(TOKENIZER, encoding="utf-8").read())
    for at in range(0, 700_000, 20_000):
        words.encode(b" ".join(b"%x" % i for i in range(at, at + 20_000)))
        assert len(words.known) + len(words.former) <= 650_000 and len(words.parts) <= 300_000
    assert words.known and words.former


def test_latin_words_are_split_alike_by_both_libraries():
    import re

    import regex
    pattern = r"'s|'t|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    found = packing._latin_pattern(pattern)
    assert isinstance(found, re.Pattern)
    assert not isinstance(packing._latin_pattern(r"\p{L}+"), re.Pattern)
    letters = [c for c in map(chr, range(0x21, 0x250)) if packing.LATIN.fullmatch(c)]
    words = [a + b for c in letters for a in (c, c.lower()) for b in ("", "a", "7", "'s", "_", ".")]
    assert [found.findall(w) for w in words] == [regex.findall(pattern, w) for w in words]
