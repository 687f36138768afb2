import hashlib
import math
import random
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest

from platelake.llm import mixing
from platelake.llm.maxscore import Top, search, top_k
from tests.llm.conftest import awkward_rows


def test_search_agrees_with_products():
    rng = np.random.default_rng(1)
    for scale in (1, 40, 2000):
        columns = rng.integers(-scale, scale + 1, (12, 700))
        ids = rng.permutation(700)
        q = rng.integers(-scale, scale + 1, 12)
        top = Top(7)
        for part in np.array_split(np.arange(700), 5):
            c = columns[:, part]
            search(q, 3, ids[part], c, c.min(1), c.max(1), top)
        want = sorted((-int(q @ columns[:, k]), int(i)) for k, i in enumerate(ids) if i != 3)[:7]
        assert [(-int(s), int(i)) for s, i in zip(top.scores, top.ids)] == want


def test_top_k_awkward(spark):
    rng = random.Random(2)
    rows = [(i, [rng.choice([0.0, 0.5, -0.25, 1.0]) for _ in range(6)]) for i in range(350)]
    rows += [(400, None), (500, [1.0, None, 0.0]), (600, [float("nan")] * 6), (700, [float("inf")] * 6), (800, []), (900, [1.0, 2.0]), (None, [1.0] * 6), (3, rows[3][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    got = top_k(df, df.filter("vec_id % 100 = 0"), shard=64, block=2)
    clean = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for q, w in ((i, v) for i, v in clean if i % 100 == 0):
        best = sorted((-sum(math.floor(1024 * a) * math.floor(1024 * b) for a, b in zip(w, v)), i) for i, v in clean if i != q)[:10]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_top_k_large_values(spark):
    """Scores are exact where a sum needs more than 53 bits, and an error where it fits no long; clashing names do no harm."""
    rng = random.Random(7)
    rows = [(100, [1.0, 1.0]), (1, [20000.0, 0.0]), (2, [9000.0, 0.0]), (200, [1e6 + 0.25, -3e5])]
    rows += [(1000 + 7 * k, [rng.uniform(-1e6, 1e6) for _ in range(3)]) for k in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "'x' AS q", "1 AS id", "2 AS v", "'l' AS lane", "0 AS kind", "9 AS score")
    got = sorted(map(tuple, top_k(df, df.filter("vec_id % 100 = 0"), shard=16).collect()))
    want = []
    for q, w in ((i, v) for i, v in rows if i % 100 == 0):
        best = sorted((-sum(math.floor(1024 * a) * math.floor(1024 * b) for a, b in zip(w, v)), i) for i, v in rows if i != q)[:10]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert got == sorted(want)
    assert max(s for *_, s in got) > 2**53
    few = spark.createDataFrame([(100, [1e9]), (1, [1e9]), (2, [1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="does not fit a long"):
        top_k(few, few.filter("vec_id = 100")).collect()
    zero = spark.createDataFrame([(100, [0.0, 1.0]), (1, [1e20, 2.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in top_k(zero, zero.filter("vec_id = 100")).collect()] == [(100, 1, 1, 2 * 1024 * 1024)]


def test_top_k_empty(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert top_k(none, none).collect() == []
    few = spark.createDataFrame([(100, [1.0, 2.0])], "vec_id long, embedding array<float>")
    assert top_k(few, few).collect() == []


def count(t):
    return len((t or "").encode().split()) if t else 0


def target_rule(sizes, weights=(5, 2, 1), most=3):
    """Targets by reshaping what is above the caps until nothing is."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, held = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in held]
        left = total - sum(held.values())
        share = {s: Fraction(left * w[s], sum(w[x] for x in free)) for s in free}
        above = [s for s in free if share[s] > most * sizes[s]]
        if not above:
            return {s: float(v) for s, v in {**held, **share}.items()}
        held |= {s: Fraction(most * sizes[s]) for s in above}


def slots_rule(targets, block):
    """How many golden-ratio slots each source gets, and its block length."""
    lengths = [max(1, block)]
    while lengths[-1] > 1:
        lengths.append(max(1, lengths[-1] // 16))
    length = {s: next((n for n in lengths if t >= n * 512), 1) for s, t in targets.items() if t > 0}
    got = dict.fromkeys(targets, 0)
    for n in lengths:
        names = sorted((s for s in length if length[s] == n), key=lambda s: (s is not None, s or ""))
        total = sum(targets[s] for s in names)
        for i in range(math.ceil(total / n - 0.5)):
            u, at = i * mixing.STEP % 1.0, 0.0
            for s in names:
                at += targets[s]
                if u < at / total or s == names[-1]:
                    got[s] += 1
                    break
    return got, length


def mix_rule(rows, weights=(5, 2, 1), block=1024, slots=slots_rule):
    sizes = defaultdict(int)
    for _, t, _, s, *_ in rows:
        sizes[s] += count(t)
    targets = target_rule(sizes, weights)
    got, length = slots(targets, block)
    streams = defaultdict(list)
    for i, t, _, s, *_ in rows:
        streams[s].append((i is None, "" if i is None else hashlib.md5(str(i).encode()).hexdigest(), count(t), i))
    out = []
    for s, docs in streams.items():
        b = length.get(s, 1)
        per = -(-sizes[s] // b)
        full, rest = divmod(min(got[s], 3 * per), per) if per else (0, 0)
        at = 0
        for _, _, n, i in sorted(docs, key=lambda d: d[:3]):
            out.append((str(i), n, sizes[s], round(targets[s], 6), full * n + max(0, min(at + n, rest * b) - at)))
            at += n
    return sorted(out)


def mixed(found):
    return sorted((str(r["doc_id"]), r["size"], r["source_size"], round(r["target"], 6), r["taken"]) for r in found)


@pytest.mark.parametrize("block", [1024, 7])
def test_mix_awkward(awkward, block):
    got = mixed(mixing.mix_sources(awkward, block_words=block).collect())
    assert got == mix_rule(awkward_rows(), block=block)
    assert all(taken <= 3 * size for _, size, _, _, taken in got)


def test_mix_caps_and_tiny_sources(spark):
    rows = [(i, "w " * (400 if i % 5 else 3), "en", f"s{min(i % 9, 6)}" if i % 8 else None, 0) for i in range(90)] + [(999, "one", "en", "zz", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = mixed(mixing.mix_sources(docs, weights=(50, 1), block_words=16).collect())
    assert got == mix_rule(rows, (50, 1), 16)
    assert mixed(mixing.mix_sources(docs.repartition(7), weights=(50, 1), block_words=16).collect()) == got


def near_targets(got, sources):
    """Taken words of each source against its target."""
    sums, target = defaultdict(int), {}
    for i, _, _, t, taken in got:
        sums[sources[i]] += taken
        target[sources[i]] = t
    assert all(abs(sums[s] - t) <= max(3, 0.01 * t) for s, t in target.items()), (sums, target)


def test_targets_are_met(spark, corpus):
    docs = [(i, "w " * (1 + i * 7 % 900), "en", f"s{i % 13 if i % 3 else 0}", 0) for i in range(3000)]
    got = mixed(mixing.mix_sources(spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")).collect())
    near_targets(got, {str(i): s for i, _, _, s, _ in docs})
    got = mixed(mixing.mix_sources(corpus).collect())
    near_targets(got, {str(r["doc_id"]): r["source"] for r in corpus.collect()})


def test_the_schedule_decides(spark, monkeypatch):
    """What a source is given depends on its slots: another schedule gives another mix."""
    docs = spark.createDataFrame([(i, "w " * 500, "en", f"s{i % 3}", 0) for i in range(300)], "doc_id long, text string, lang string, source string, n_chars long")
    real = mixing.schedule
    before = mixed(mixing.mix_sources(docs).collect())
    monkeypatch.setattr(mixing, "schedule", lambda sources, slots: real(sources.filter("source = 's0'"), slots))
    one = mixed(mixing.mix_sources(docs).collect())
    assert sum(r[-1] for r in one) < sum(r[-1] for r in before) and {r[-1] for r in one} >= {0}
    monkeypatch.setattr(mixing, "schedule", lambda sources, slots: real(sources, min(slots, 1)))
    assert sum(r[-1] for r in mixed(mixing.mix_sources(docs).collect())) <= 3 * 1024


def test_many_rows_without_identifier(spark):
    rows = [(None, "a b c", None, "s", 0)] * 400 + [(k, "x y", None, "t", 0) for k in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    assert mixed(mixing.mix_sources(docs).collect()) == mix_rule(rows)


def test_mix_without_words(spark, empty):
    assert mixing.mix_sources(empty).collect() == []
    docs = spark.createDataFrame([(1, None, "en", None, 0), (2, "", "en", "a", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    assert mixed(mixing.mix_sources(docs).collect()) == [("1", 0, 0, 0.0, 0), ("2", 0, 0, 0.0, 0)]


def test_schedule_is_golden_and_ranked(spark):
    sources = spark.createDataFrame([("a", "sa", 50.0), ("b", "sb", 30.0), (None, "n", 20.0)], "source string, skey string, target double")
    got = sorted(mixing.schedule(sources, 2000).collect(), key=lambda r: r["slot"])
    seen = defaultdict(int)
    for r in got:
        u = r["slot"] * mixing.STEP % 1.0
        assert r["skey"] == ("n" if u < 0.2 else "sa" if u < 0.7 else "sb")
        assert r["rank"] == seen[r["skey"]]
        seen[r["skey"]] += 1
        assert abs(seen["sa"] - 0.5 * (r["slot"] + 1)) < 6
    assert len(got) == 2000


def test_mix_query(spark, corpus):
    from platelake.llm.queries import QUERIES

    rows = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in corpus.collect()]
    assert mixed(QUERIES["op9_mixing"](spark, "/root/testdata/sf0.001").collect()) == mix_rule(rows)
