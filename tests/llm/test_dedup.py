import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
import xxhash

from platelake.llm import simhash
from platelake.llm.components import components
from platelake.llm.exact_dedup import exact_dedup
from platelake.llm.substring_dedup import levels, remove_repeats
from tests.llm.conftest import LOWER, awkward_rows

sha = lambda b: hashlib.sha256(b).hexdigest()


def exact_rule(rows):
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[(t or "").encode().translate(LOWER)].append(i)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        spent = False
        for i in ids:
            kept = i == keep and not spent
            spent |= kept
            out.append((str(i), str(keep), len(ids), kept, sha(text)))
    return sorted(out)


def told(found):
    return sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"], r["kept"], r["text_sha256"]) for r in found)


def test_exact_awkward(awkward):
    assert told(exact_dedup(awkward).collect()) == exact_rule(awkward_rows())


def test_exact_group_over_many_partitions(spark):
    rows = [(i, "Same TEXT" if i % 3 else f"t{i // 6}", None, None, None) for i in range(900)]
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
        assert told(exact_dedup(docs).collect()) == exact_rule(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_exact_empty(empty):
    assert exact_dedup(empty).collect() == []


def test_exact_query(spark, corpus):
    from platelake.llm.queries import QUERIES

    assert told(QUERIES["op7_exact_dedup"](spark, "/root/testdata/sf0.001").collect()) == exact_rule([(r["doc_id"], r["text"]) for r in corpus.collect()])


def words(t):
    return [w for w in re.split(r"[\x20\x09-\x0d]+", t or "") if w]


def substring_rule(rows, n):
    cut = [(i, words(t)) for i, t, *_ in rows]
    seen = Counter(tuple(w[k : k + n]) for _, w in cut for k in range(len(w) - n + 1))
    out = []
    for i, w in cut:
        gone = [False] * len(w)
        for k in range(len(w) - n + 1):
            if seen[tuple(w[k : k + n])] > 1:
                gone[k : k + n] = [True] * n
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((str(i), len(w), sum(gone), sha(kept.encode())))
    return sorted(out)


def cut_told(found):
    return sorted((str(r[0]), r[1], r[2], r[3]) for r in found)


def test_levels():
    assert levels(35) == [9, 18, 35] and levels(8) == [8]


@pytest.mark.parametrize("window", [35, 4])
def test_substring_awkward(awkward, window):
    assert cut_told(remove_repeats(awkward, window).collect()) == substring_rule(awkward_rows(), window)


def test_substring_random(spark):
    rng = random.Random(3)
    passages = [[f"p{k}_{j}" for j in range(60)] for k in range(4)]
    rows = []
    for i in range(120):
        w = [rng.choice("abcd") for _ in range(rng.randint(0, 50))]
        for _ in range(rng.randint(0, 2)):
            p, a = rng.choice(passages), rng.randint(0, 25)
            at = rng.randint(0, len(w))
            w[at:at] = p[a : a + rng.randint(30, 40)]
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = remove_repeats(docs, with_text=True).collect()
    assert cut_told(r[:4] for r in got) == substring_rule(rows, 35)
    assert all(sha(r["kept"].encode()) == r["kept_sha256"] for r in got)


def test_substring_words_of_one_pattern_are_told_apart(spark):
    """A Thue-Morse word and its complement cancel out in sums of powers modulo 2^64; so would sequences of two words."""
    common = " ".join(f"c{k}" for k in range(34))
    rows = []
    for n in (1024, 2048, 64):
        bits = [k.bit_count() % 2 for k in range(n)]
        sep, pair = ("", "ab") if n > 64 else (" ", ("one", "two"))
        rows += [(len(rows) + i, f"{common} " * (n > 64) + sep.join(pair[b ^ i] for b in bits)) for i in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = remove_repeats(docs).collect()
    assert cut_told(got) == substring_rule(rows, 35)
    assert [r["n_removed"] for r in sorted(got)][:4] == [0, 0, 0, 0]


def test_substring_nothing_repeats_and_empty(spark, empty):
    docs = spark.createDataFrame([(1, " ".join(f"u{i}" for i in range(100)))], "doc_id long, text string")
    assert [r[1:3] for r in remove_repeats(docs).collect()] == [(100, 0)]
    assert remove_repeats(empty).collect() == []


def test_substring_query(spark, corpus):
    from platelake.llm.queries import QUERIES

    assert cut_told(QUERIES["op4_substring_dedup"](spark, "/root/testdata/sf0.001").collect()) == substring_rule([(r["doc_id"], r["text"]) for r in corpus.collect()], 35)


def print_rule(text):
    w = (text or "").encode().translate(LOWER).split()
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(w[k : k + 3]), 42) for k in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def component_rule(rows):
    fps = [(i, print_rule(t)) for i, t, *_ in rows]
    group = {f: f for _, f in fps}

    def find(f):
        while group[f] != f:
            f = group[f]
        return f

    every = sorted(group)
    for k, a in enumerate(every):
        for b in every[k + 1 :]:
            if (a ^ b).bit_count() <= 2:
                group[find(b)] = find(a)
    least = {}
    for i, f in fps:
        if i is not None:
            least[find(f)] = min(least.get(find(f), i), i)
    return sorted((str(i), f"{f:016x}", str(least.get(find(f)))) for i, f in fps)


def near_told(found):
    return sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in found)


def test_masks_cover_the_radius():
    got = simhash.masks(2)
    assert len(got) == 7
    for i in range(64):
        for j in range(i, 64):
            assert any(not m >> i & 1 and not m >> j & 1 for m in got)


def test_simhash_awkward(awkward):
    assert near_told(simhash.simhash_components(awkward).collect()) == component_rule(awkward_rows())


def test_simhash_empty(empty):
    assert simhash.simhash_components(empty).collect() == []


def test_simhash_query(spark, corpus):
    from platelake.llm.queries import QUERIES

    assert near_told(QUERIES["op8_simhash"](spark, "/root/testdata/sf0.001").collect()) == component_rule([(r["doc_id"], r["text"]) for r in corpus.collect()])


@pytest.mark.parametrize("bucket, radius", [(4096, 2), (3, 2), (4096, 4), (3, 4), (3, 0)])
def test_links_reach_what_pairs_reach(spark, bucket, radius):
    rng = random.Random(5)
    fps = set()
    for _ in range(12):
        at = rng.getrandbits(64)
        for _ in range(14):
            fps.add(at)
            for _ in range(rng.randint(1, 3)):
                at ^= 1 << rng.randrange(64)
    signed = lambda f: f - (1 << 64) if f >> 63 else f
    edges = simhash.links(spark.createDataFrame([(signed(f),) for f in fps], "fp long"), radius, bucket)
    got = {r["node"]: r["root"] for r in components(edges).collect()}
    group = {f: f for f in fps}

    def find(f):
        while group[f] != f:
            f = group[f]
        return f

    for a in fps:
        for b in fps:
            if 0 < (a ^ b).bit_count() <= radius:
                group[find(a)] = find(b)
    for a in fps:
        for b in fps:
            assert (find(a) == find(b)) == (got.get(signed(a), signed(a)) == got.get(signed(b), signed(b)))


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(50)] + [(100, 101), (101, 101)], "u long, v long")
    got = {r["node"]: r["root"] for r in components(edges).collect()}
    assert got == {**{k: 0 for k in range(51)}, 100: 100, 101: 100}
