"""The stages of the corpus pipeline, each on what the one before kept, against brute-force versions."""

import itertools
from collections import Counter

import pytest

import corpus_pipeline
from panelscore.llm import common, pieces
from tests.llm.test_operators import WORD, brute_base, brute_fingerprint, low, roots, shared_out, texts


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """Name -> (input, output) of each stage."""
    docs = common.session(spark).read.parquet(f"{sf_dir}/documents.parquet")
    found = {}
    for name, step in corpus_pipeline.STAGES:
        out = common.stage(step(spark, docs, sf_dir), f"test-{name}")
        found[name] = (docs, out)
        docs = out
    return found


def test_all_but_the_last_keep_the_columns(stages):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert all(stages[n][1].columns == stages[n][0].columns for n in names[:-1])


def test_quality_rules(stages, spark, sf_dir):
    before, after = (texts(x) for x in stages["quality_rules"])
    good = {r[0] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").select("doc_id").collect()}
    assert not [i for i in after if brute_base(before[i])[-1]]
    assert not [i for i in before if i in good and i not in after and not brute_base(before[i])[-1]]
    assert all(before[i] == t for i, t in after.items())


def test_one_document_of_each_group_of_near_duplicates_stays(stages):
    before, after = (texts(x) for x in stages["simhash_near_dedup"])
    prints = {i: brute_fingerprint(t) for i, t in before.items()}
    of = roots(prints, [(a, b) for a, b in itertools.combinations(prints, 2)
                        if (prints[a] ^ prints[b]).bit_count() <= 4])
    assert after == {i: before[i] for i in set(of.values())}


def test_repeated_passages_are_cut(stages):
    before, after = (texts(x) for x in stages["substring_dedup"])

    def shared(split, n):
        seen = {}
        for i, w in split.items():
            for a in range(len(w) - n + 1):
                seen.setdefault(tuple(w[a:a + n]), set()).add(i)
        return {i for ids in seen.values() if len(ids) > 1 for i in ids}

    assert not shared({i: low(t) for i, t in after.items()}, 50)
    alone = set(before) - shared({i: low(t) for i, t in before.items()}, 20)
    assert all(after[i] == before[i] for i in alone)
    for i, t in after.items():  # what is left is in order, and nothing is added
        words = iter(WORD.findall(before[i]))
        assert all(w in words for w in WORD.findall(t))


def test_mixing_meets_the_targets(stages):
    before, after = (x.select("doc_id", "source", "text").collect() for x in stages["source_mixing"])
    sizes, taken, times = Counter(), Counter(), Counter()
    for r in before:
        sizes[r["source"]] += len(WORD.findall(r["text"]))
    for r in after:
        taken[r["source"]] += len(WORD.findall(r["text"]))
        times[r["doc_id"]] += 1
    want = shared_out(sizes)
    assert all(abs(taken[s] - t) <= 1 for s, t in want.items()) and max(times.values()) <= 2


def test_pieces(stages):
    sentencepiece = pytest.importorskip("sentencepiece")
    model = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    before, after = stages["sentencepiece"]
    want = Counter((r["doc_id"], tuple(model.encode(r["text"]))) for r in before.collect())
    assert want == Counter((r["doc_id"], tuple(r["ids"])) for r in after.collect())
    assert after.where("not round_trip").count() == 0


def test_run_is_the_stages_in_order(stages, spark, sf_dir):
    got = corpus_pipeline.run(spark, sf_dir).select("doc_id", "n_tokens").collect()
    want = stages["sentencepiece"][1].select("doc_id", "n_tokens").collect()
    assert sorted(got) == sorted(want)


def test_unusual_tables(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, row string, ids int"
    long = " ".join(f"w{i}" for i in range(3000))
    rows = [(1, None, None, None, None, None, None), (None, long, "en", None, 1, "x", 1), (2, "", "en", "a", 0, "x", 1),
            (3, long, "en", "a", 1, None, 2), (3, long, "en", "a", 1, None, 2), (4, long + " more", "de", "b", 1, "y", 3)]
    session = common.session(spark)
    session.createDataFrame([(3, 1, 0), (None, None, None)], "doc_id long, quality int, toxic int").write.parquet(
        str(tmp_path / "full" / "labels.parquet"))
    session.createDataFrame(rows, schema).write.parquet(str(tmp_path / "full" / "documents.parquet"))
    docs, kept = session.read.parquet(str(tmp_path / "full" / "documents.parquet")), {}
    for name, step in corpus_pipeline.STAGES:
        docs = common.stage(step(session, docs, str(tmp_path / "full")), f"unusual-{name}")
        kept[name] = docs.collect()
    ids = {name: Counter(r["doc_id"] for r in found) for name, found in kept.items()}
    # too few words in 1 and 2; 4 is a near copy; an id that repeats is one document, a row without an id its own
    assert ids["quality_rules"] == {None: 1, 3: 2, 4: 1}
    assert ids["simhash_near_dedup"] == ids["substring_dedup"] == {None: 1, 3: 2}
    assert all(r["text"] == long for r in kept["substring_dedup"])
    taken = Counter()
    for r in kept["source_mixing"]:
        taken[r["source"]] += len(WORD.findall(r["text"]))
    assert taken == {"a": 10125, None: 3375}  # 150 % of 9000 words as 3 to 1
    assert set(ids["sentencepiece"]) == {None, 3} and all(r["round_trip"] for r in kept["sentencepiece"])
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in kept["sentencepiece"]) == Counter(
        (r["doc_id"], tuple(r["ids"])) for r in corpus_pipeline.run(spark, str(tmp_path / "full")).collect())
    session.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(
        str(tmp_path / "none" / "labels.parquet"))
    session.createDataFrame([], schema).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0
