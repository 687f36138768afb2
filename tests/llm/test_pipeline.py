import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import tiktoken
from tiktoken.load import load_tiktoken_bpe

from tests.llm.conftest import LOWER, SCHEMA
from tests.llm.test_search_and_mix import mix_rule

pipeline = pytest.importorskip("corpus_pipeline")
SF = "/root/testdata/sf0.001"
STAGES = dict(pipeline.STAGES)


def rows_of(df):
    return [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]


def check_exact(before, after):
    key = lambda r: (r[1] or "").encode().translate(LOWER)
    best = {}
    for r in before:
        if key(r) not in best or (r[0] is not None and (best[key(r)] is None or r[0] > best[key(r)])):
            best[key(r)] = r[0]
    assert Counter((key(r), r[0]) for r in after) == Counter(best.items())


def least_of_groups(before):
    """The least identifier (null last) of each group of rows joined by steps of five-word Jaccard similarity 0.8 or more."""
    cut = [(t or "").encode().translate(LOWER).split() for _, t, *_ in before]
    sets = [frozenset(b" ".join(w[k : k + 5]) for k in range(max(1, len(w) - 4))) for w in cut]
    root = list(range(len(before)))
    for a in range(len(before)):
        for b in range(a):
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                root = [min(root[a], root[b]) if r in (root[a], root[b]) else r for r in root]
    groups = {}
    for r, (i, *_) in zip(root, before):
        groups.setdefault(r, []).append((i is None, i or 0))
    return Counter(map(min, groups.values()))


def check_near(before, after):
    assert Counter((r[0] is None, r[0] or 0) for r in after) == least_of_groups(before)
    assert not Counter(after) - Counter(before)


def check_mix(before, after):
    want = Counter()
    for i, size, _, _, taken in mix_rule(before):
        if taken:
            want[i] += int(taken / size + 0.5)
    assert Counter(str(r[0]) for r in after) == +want
    kinds = Counter(before)
    assert all(r in kinds for r in after)


def check_tokens(before, got):
    """Against the tiktoken library with the same ranks."""
    library = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_tiktoken_bpe(public_tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={})
    want = Counter((str(i), tuple(library.encode_ordinary(t or ""))) for i, t, *_ in before)
    assert Counter((str(r["doc_id"]), tuple(r["ids"])) for r in got) == want
    assert all(r["n_tokens"] == len(r["ids"]) for r in got)


def check_toxicity(spark, before, after, labels):
    """The rows that the classifier calls clean, each whole; few of those labelled clean go."""
    assert not Counter(after) - Counter(before)
    gone = {r[0] for r in before} - {r[0] for r in after}
    assert sum(labels.get(i) == 0 for i in gone) <= 0.03 * max(1, sum(t == 0 for t in labels.values()))


@pytest.mark.parametrize("source", ["corpus", "awkward"])
def test_each_stage(spark, source, corpus, awkward):
    """Every stage on the whole table, whatever rows it holds."""
    docs = corpus if source == "corpus" else awkward
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()} if source == "corpus" else {}
    kept = STAGES["toxicity"](spark, docs, SF)
    assert kept.columns == docs.columns
    check_toxicity(spark, rows_of(docs), rows_of(kept), labels)
    for name, check in (("exact_dedup", check_exact), ("simhash_dedup", check_near), ("mixing", check_mix)):
        got = STAGES[name](spark, docs, SF)
        assert got.columns == docs.columns
        check(rows_of(docs), rows_of(got))
    check_tokens(rows_of(docs), STAGES["byte_bpe"](spark, docs, SF).collect())


def test_empty(spark, empty):
    for name, stage in pipeline.STAGES:
        assert stage(spark, empty, SF).collect() == [], name


def test_run(spark, corpus):
    """run() gives what the rules give one after another."""
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "exact_dedup", "simhash_dedup", "mixing", "byte_bpe"]
    docs = STAGES["toxicity"](spark, corpus, SF)
    for name, check in (("exact_dedup", check_exact), ("simhash_dedup", check_near), ("mixing", check_mix)):
        before, docs = docs, STAGES[name](spark, docs, SF)
        check(rows_of(before), rows_of(docs))
    got = pipeline.run(spark, SF).collect()
    assert got
    check_tokens(rows_of(docs), got)
    texts = {r[0]: r[1] for r in rows_of(corpus)}
    assert all(r["decoded_sha256"] == hashlib.sha256((texts[r["doc_id"]] or "").encode()).hexdigest() for r in got)


def test_numbers_do_not_move(spark, tmp_path):
    """Rows are told apart by stored numbers, so that what is kept does not depend on how a scan is cut."""
    rows = [(i // 2, f"text {i % 50} of the row", "en", "s", i) for i in range(4000)]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.option("parquet.block.size", 4096).parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    found = []
    for size in ("128m", "16k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            got = STAGES["exact_dedup"](spark, docs, SF)
            spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")  # between planning and running
            found.append(Counter(r[:2] for r in rows_of(got)))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found[0] == found[1] and len(found[0]) == 50
    check_exact(rows_of(docs), rows_of(STAGES["exact_dedup"](spark, docs, SF)))


def test_similar_texts_leave_one(spark):
    """Copies of five-word similarity 0.8 or more go, at lengths where the fingerprints of most are further than 2 bits apart."""
    rng = random.Random(5)
    rows = []
    for n, changed in ((100, 1), (300, 3), (300, 1), (1000, 10), (60, 1)):
        for _ in range(12):
            words = [f"w{rng.randrange(50_000)}" for _ in range(n)]
            other = list(words)
            for at in rng.sample(range(2, n - 2), changed):
                other[at] = f"x{rng.randrange(50_000)}"
            rows += [(len(rows), " ".join(words)), (len(rows) + 1, " ".join(other))]
    sets = [frozenset(zip(*(t.split()[k:] for k in range(5)))) for _, t in rows]
    alike = lambda a, b: len(a & b) >= 0.8 * len(a | b)
    root = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if alike(sets[a], sets[b]):
                root = [min(root[a], root[b]) if r in (root[a], root[b]) else r for r in root]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], SCHEMA).repartition(3)
    got = STAGES["simhash_dedup"](spark, docs, SF)
    assert sorted(r[0] for r in rows_of(got)) == sorted(set(root)) and len(set(root)) == 60


def test_similar_on_the_corpus_and_lanes(spark, corpus, awkward, monkeypatch):
    """Against every pair, with large clusters in one lane and dealt over many."""
    from platelake.llm import jaccard

    for lane in (1024, 3):
        monkeypatch.setattr(jaccard, "LANE", lane)
        for docs in (corpus, awkward):
            after = STAGES["simhash_dedup"](spark, docs, SF)
            assert after.columns == docs.columns
            check_near(rows_of(docs), rows_of(after))


def test_large_cluster_is_not_dealt_as_all_pairs(spark, monkeypatch):
    """Copies of one text in a large cluster are joined by its pivots; only the rest meets all others, and no link is lost."""
    import numpy as np

    from platelake.llm import jaccard

    rng = np.random.default_rng(3)
    core = rng.integers(0, 1 << 60, 60)
    sets = {}
    for i in range(800):  # near copies of one text, then a chain whose ends alone are far from it, then unlike documents
        sets[i] = np.unique(np.append(core[:58], rng.integers(0, 1 << 60, 2)))
    for k in range(8):
        sets[800 + k] = np.unique(np.append(core[5 * k + 5 :], 7_000 + np.arange(5 * k + 5)))
    for i in range(808, 820):
        sets[i] = np.unique(rng.integers(0, 1 << 60, 60))
    rows = [(i, 0, len(s), s.astype("<u8").tobytes()) for i, s in sets.items()]
    held = spark.createDataFrame(rows, "row long, cluster long, n int, found binary").repartition(4)
    monkeypatch.setattr(jaccard, "LANE", 20)
    once = jaccard._dealt_once(held)
    assert once.count() <= len(sets) + jaccard.PIVOTS * 41
    assert max(r["count"] for r in once.groupBy("cluster", "a", "b").count().collect()) < 80
    roots = jaccard.compared_components(held, 0.8)
    got = {r["node"]: r["root"] for r in roots.collect()}
    want = {i: i for i in sets}
    for a in sorted(sets):
        for b in range(a):
            common = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
            if common >= 0.8 * (len(sets[a]) + len(sets[b]) - common):
                old, new = max(want[a], want[b]), min(want[a], want[b])
                if old != new:
                    want = {i: new if r == old else r for i, r in want.items()}
    assert {i: got.get(i, i) for i in sets} == want and len(set(want.values())) > 1
    alike = jaccard.components(jaccard._edges(once, 0.8))
    assert jaccard._dealt_across(held, alike).count() <= 4 * len(sets)
