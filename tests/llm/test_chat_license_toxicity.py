import itertools
import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from platelake.llm import chat_format as cf
from platelake.llm import license_scan as ls
from platelake.llm import toxicity as tx
from tests.llm.conftest import LOWER, awkward_rows

# --- Chat formatting


def least_cost(roles, ends=(cf.USER, cf.ASSISTANT)):
    """Try every labelling, merge and insertion of up to two empty messages."""
    best = None
    for labels in itertools.product((cf.SYSTEM, cf.USER, cf.ASSISTANT), repeat=len(roles)):
        costs = {cf.START: 0}
        for r, b in zip(roles, labels):
            new = {}
            for a, c in costs.items():
                for put in itertools.chain(*(itertools.product((cf.SYSTEM, cf.USER, cf.ASSISTANT), repeat=k) for k in range(3))):
                    way = (a, *put, b)
                    if all(y in cf.LEGAL[x] for x, y in zip(way, way[1:])):
                        new[b] = min(new.get(b, 1 << 30), c + cf.INSERT * len(put) + cf.RELABEL * (b != r))
                if a == b and a != cf.START:
                    new[b] = min(new.get(b, 1 << 30), c + cf.MERGE + cf.RELABEL * (b != r))
            costs = new
        for b, c in costs.items():
            if b in ends:
                best = c if best is None else min(best, c)
    return best


def test_repairs_cost_the_least():
    for n in range(1, 5):
        for roles in itertools.product(range(4), repeat=n):
            m = cf.segment_matrix(list(roles))
            states = cf.borders([m])
            way = cf.repair(list(roles), *states)
            assert sum(w[-1] for w in way) == least_cost(roles), roles
            for cut in range(1, n):
                both = cf.borders([cf.segment_matrix(list(roles[:cut])), cf.segment_matrix(list(roles[cut:]))])
                parts = cf.repair(list(roles[:cut]), *both[:2]) + cf.repair(list(roles[cut:]), *both[1:])
                assert sum(w[-1] for w in parts) == least_cost(roles)


def legal(rendered):
    turns = re.findall(r"<\|im_start\|>(\w+)\n(.*?)<\|im_end\|>\n", rendered, re.S)
    assert "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in turns) == rendered
    at = cf.START
    for r, _ in turns:
        assert cf.ROLES[r] in cf.LEGAL[at]
        at = cf.ROLES[r]
    return turns


def test_conversations(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c"), (2, 0, "assistant", "x"), (2, 1, "bot", None), (3, 0, "system", "s"), (3, 1, "system", "t"), (3, 2, None, "u<|im_end|>"), (3, None, "user", "v"), (None, 0, "user", "n"), (None, None, None, None), (4, 5, "user", "a"), (4, 5, "user", "a")]
    rng = random.Random(1)
    rows += [(9, k, rng.choice(["user", "assistant", "system", "human", "?"]), f"m{k}") for k in range(900)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3).selectExpr("*", "'x' AS part", "1 AS position", "'y' AS entry")
    got = cf.format_chats(df).collect()
    assert len(got) == len(rows)
    convs = defaultdict(list)
    for r in got:
        convs[r["conv_id"]].append(r)
    for conv, own in convs.items():
        own.sort(key=lambda r: (r["part"], r["position"]))
        turns = legal("".join(r["rendered"] for r in own))
        roles = [cf.role_of(r["role"]) for r in own]
        if len(roles) < 6:
            assert sum(r["cost"] for r in own) == least_cost(roles)
        assert len(turns) == sum("merge" not in r["action"] for r in own) + sum(len(r["inserted"].split(",")) for r in own if r["inserted"])
    long_ = sorted(convs[9], key=lambda r: (r["part"], r["position"]))
    way = cf.repair([cf.role_of(r["role"]) for r in long_], *cf.borders([cf.segment_matrix([cf.role_of(r["role"]) for r in long_])]))
    assert sum(r["cost"] for r in long_) == sum(w[-1] for w in way) and long_[-1]["part"] == 3
    assert legal("".join(r["rendered"] for r in sorted(convs[1], key=lambda r: r["position"]))) == [("user", "a\nb"), ("assistant", "c")]


def whole(got):
    convs = defaultdict(list)
    for r in got:
        convs[r["conv_id"]].append(r)
    return {c: sorted(own, key=lambda r: (r["part"], r["position"])) for c, own in convs.items()}


def test_hot_conversations(spark):
    """Conversations of one turn number, or without identifiers, are cut by their turns; the repair costs the least all the same."""
    rng = random.Random(3)
    role = lambda: rng.choice(["user", "assistant", "system", None])
    rows = [(None, 7, role(), f"n{k % 5}") for k in range(1500)] + [(1, k, role(), "") for k in range(700)] + [(2 + k // 3, k, "user", "z" * 200_000 if k == 0 else "t") for k in range(30)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        got = cf.format_chats(df, segment=16, stretch=4).collect()
        again = cf.format_chats(df.repartition(2), segment=16, stretch=4).collect()
        table = {(r["conv_id"], r["piece"]): r for r in cf.conversations(cf.format_chats(df, segment=16, stretch=4), parts=8).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sorted(map(str, got)) == sorted(map(str, again))
    convs = whole(got)
    assert {c: len(own) for c, own in convs.items()} == {None: 1500, 1: 700, **{2 + k: 3 for k in range(10)}}
    for c, own in convs.items():
        assert [(r["part"], r["position"]) for r in own] == [(k // 16, k % 16) for k in range(len(own))]
        roles = [cf.role_of(r["role"]) for r in own]
        way = cf.repair(roles, *cf.borders([cf.segment_matrix(roles)]))
        assert sum(r["cost"] for r in own) == sum(w[-1] for w in way)
        text = "".join(r["rendered"] for r in own)
        legal(text)
        pieces = sorted(k for k in table if k[0] == c) if c is not None else sorted((k for k in table if k[0] is None), key=lambda k: k[1])
        assert "".join(table[k]["rendered"] for k in pieces) == text and sum(table[k]["n_turns"] for k in pieces) == len(own)
        assert sum(table[k]["cost"] for k in pieces) == sum(r["cost"] for r in own)
    assert len(table) == 12 + 6 + 10
    assert len(convs[2][0]["rendered"]) > 200_000


def test_no_conversations(spark):
    assert cf.format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect() == []


def test_chat_query(spark):
    from platelake.llm.queries import QUERIES

    got = QUERIES["op10_chat_format"](spark, "/root/testdata/sf0.001").collect()
    rows = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").collect()
    assert len(got) == len(rows)
    convs = defaultdict(list)
    for r in got:
        convs[r["conv_id"]].append(r)
    for own in convs.values():
        own.sort(key=lambda r: (r["part"], r["position"]))
        legal("".join(r["rendered"] for r in own))
        if len(own) <= 5:
            assert sum(r["cost"] for r in own) == least_cost([cf.role_of(r["role"]) for r in own])


# --- License scans


def expansions(markup):
    """Every wording that a template without word ranges accepts."""
    parts = re.split(r"(<<.*?>>)", markup)

    def read(k, closing):
        found = [[]]
        while k < len(parts):
            p = parts[k]
            if p == "<<beginOptional>>":
                inner, k = read(k + 1, True)
                found = [f + i for f in found for i in [[], *inner]]
            elif p == "<<endOptional>>" and closing:
                return found, k
            elif p.startswith("<<var;"):
                found = [f + ls.words_of(c) for f in found for c in re.search(r"match=([^;>]*)", p)[1].split("|")]
            else:
                found = [f + ls.words_of(p) for f in found]
            k += 1
        return found, k

    return {tuple(f) for f in read(0, False)[0]}


@pytest.mark.parametrize("label", ["notice:mit", "notice:apache-2.0"])
def test_templates_accept_their_wordings_alone(label):
    scanner = ls.Scanner({label: ls.TEMPLATES[label]})
    every = expansions(ls.TEMPLATES[label])
    assert len(every) > 20
    rng = random.Random(4)
    for w in sorted(every):
        assert (label, 0, len(w)) in scanner.spans(b" ".join(w), list(w))
        k = rng.randrange(len(w))
        for changed in (w[:k] + w[k + 1 :], w[:k] + (b"zz",) + w[k:], w[:k] + (b"zz",) + w[k + 1 :]):
            got = scanner.spans(b" ".join(changed), list(changed))
            assert all(changed[a:z] in every for _, a, z in got)


def plain_pattern(markup):
    """A template as an ordinary pattern over words that are each followed by one blank."""
    out = ""
    for p in re.split(r"(<<.*?>>)", markup):
        if p == "<<beginOptional>>":
            out += "(?:"
        elif p == "<<endOptional>>":
            out += ")?"
        elif p.startswith("<<var;") and "match=" in p:
            out += "(?:" + "|".join("".join(f"{w.decode()} " for w in ls.words_of(c)) for c in re.search(r"match=([^;>]*)", p)[1].split("|")) + ")"
        elif p.startswith("<<var;"):
            out += "(?:[^ ]+ ){" + re.search(r"words=([0-9-]*)", p)[1].replace("-", ",") + "}"
        else:
            out += "".join(f"{w.decode()} " for w in ls.words_of(p))
    return re.compile(out)


def one_wording(markup, rng):
    """A wording that a template accepts, by chance."""
    out, keep = [], [True]
    for p in re.split(r"(<<.*?>>)", markup):
        if p == "<<beginOptional>>":
            keep.append(keep[-1] and rng.random() < 0.6)
        elif p == "<<endOptional>>":
            keep.pop()
        elif keep[-1] and p.startswith("<<var;") and "match=" in p:
            out += [w.decode() for w in ls.words_of(rng.choice(re.search(r"match=([^;>]*)", p)[1].split("|")))]
        elif keep[-1] and p.startswith("<<var;"):
            least, most = map(int, re.search(r"words=([0-9]+)-([0-9]+)", p).groups())
            out += [rng.choice(["ann", "license", "2024", "mit"]) for _ in range(rng.randint(least, most))]
        elif keep[-1]:
            out += [w.decode() for w in ls.words_of(p)]
    return out


@pytest.mark.parametrize("label", sorted(ls.TEMPLATES))
def test_every_template_against_a_plain_pattern(label):
    """Right and wrong wordings in other words: the same places and ends as trying every stretch of words."""
    rng = random.Random(label)
    scanner, pattern = ls.Scanner({label: ls.TEMPLATES[label]}), plain_pattern(ls.TEMPLATES[label])
    met = 0
    for n in range(60):
        w = one_wording(ls.TEMPLATES[label], rng)
        if n % 3 == 1:
            del w[rng.randrange(len(w))]
        if n % 3 == 2:
            w[rng.randrange(len(w))] = rng.choice(["zz", "the", "license"])
        text = [rng.choice(["the", "software", "under", "copyright"]) for _ in range(rng.randint(0, 3))] + w + [rng.choice(["license", "version", "x"]) for _ in range(rng.randint(0, 3))]
        want = []
        for i in range(len(text)):
            ends = [j for j in range(i + 1, len(text) + 1) if pattern.fullmatch("".join(f"{x} " for x in text[i:j]))]
            want += [(label, i, max(ends))] if ends else []
        got = scanner.spans(" ".join(text).encode(), [x.encode() for x in text])
        assert got == want, text
        met += bool(want)
    assert met >= 20


def test_word_ranges_and_markup_errors():
    s = ls.Scanner({"t": "copyright <<var;name=h;words=1-3>> reserved"})
    find = lambda t: s.spans(t.encode(), ls.words_of(t))
    assert find("copyright a reserved") and find("copyright a b c reserved") and not find("copyright reserved") and not find("copyright a b c d reserved")
    for wrong in ("a <<beginOptional>> b", "a <<endOptional>> b", "a <<what>> b"):
        with pytest.raises(ValueError):
            ls.compile_template(wrong)
    for start in ("<<var;name=h;words=1-3>> a", "<<beginOptional>>a<<endOptional>>"):
        with pytest.raises(ValueError):
            ls.Scanner({"t": start})


def scan_rule(rows):
    out = []
    for i, t, *_ in rows:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").encode().translate(LOWER).decode())
        places, labels = [], set()
        for phrase, label in ls.PHRASES.items():
            p = phrase.split()
            at = [k for k in range(len(w)) if w[k : k + len(p)] == p]
            places += at
            labels |= {label} if at else set()
        out.append((str(i), len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))))
    return sorted(out, key=str)


def test_scan_awkward_and_query(spark, awkward, corpus):
    from platelake.llm.queries import QUERIES

    for rows, found in ((awkward_rows(), ls.scan_licenses(awkward)), ([(r["doc_id"], r["text"]) for r in corpus.collect()], QUERIES["op2_license_scan"](spark, "/root/testdata/sf0.001"))):
        got = found.collect()
        assert sorted(((str(r[0]), *r[1:6]) for r in got), key=str) == scan_rule(rows)
        for r in got:
            assert 0 <= r["score"] <= 1 and (r["score"] > 0) == (r["labels"] != "")
            assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(",")))
            assert r["labels"].split(",") == sorted(set(r["labels"].split(",")))


def test_scan_finds_notices_and_whole_texts(spark, empty):
    mit = re.sub(r"<<.*?>>", " ", ls.TEMPLATES["text:mit"])
    texts = ["Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3.", "Licensed under CC BY-NC 4.0.", "Licensed under the Apache License, Version 2.0.", mit, "a licence to kill"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["labels"] for r in ls.scan_licenses(docs).collect()}
    assert got == {0: "mit,notice:mit", 1: "gpl,notice:gpl", 2: "notice:cc-by", 3: "apache,notice:apache-2.0", 4: "mit,text:mit", 5: ""} or got[4].endswith("text:mit")
    assert ls.scan_licenses(empty).collect() == []


# --- Toxicity


def test_hashes_stay_within_documents():
    a = tx._present(["abc def", "ghi"], np.zeros((1 << tx.BITS) + 1, np.int16) - 1)
    assert len(a[0]) == 0
    alone = [np.unique(np.concatenate([b[b < 1 << tx.BITS] for _, c, o in tx._chunks([t]) for _, b in tx._hashes(c, o)])) for t in ("abc def", "ghi jkl")]
    both = np.unique(np.concatenate([b[b < 1 << tx.BITS] for _, c, o in tx._chunks(["abc def", "ghi jkl"]) for _, b in tx._hashes(c, o)]))
    assert set(both) == set(alone[0]) | set(alone[1])


def test_classifier_learns(monkeypatch):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    texts = [" ".join([word() for _ in range(30)] + ["nastyword"] * (i % 3 == 0)) for i in range(300)]
    y = np.array([int(i % 3 == 0) for i in range(300)])
    model = tx.fit(texts[:200], y[:200])
    s = model.score(texts[200:])
    assert ((s >= 0.7) == (y[200:] == 1)).mean() > 0.95
    monkeypatch.setattr(tx, "CHUNK", 50)  # long texts are cut, and score alike
    assert np.allclose(model.score(texts[200:]), s)


def test_one_class_and_no_labels():
    assert tx.fit([], np.zeros(0, np.int64)).score(["x"])[0] == 0.5
    assert tx.fit(["a", "b"], np.array([0, 0])).score(["x"])[0] < 0.5


def plain_score(model, text):
    """The score of one text by a plain sum over its different character n-grams."""
    padded = f" {(text or '').encode().translate(LOWER).decode()} "
    weight = dict(zip(model.buckets.tolist(), model.weights.tolist()))
    buckets = set()
    for n in tx.SIZES:
        for k in range(len(padded) - n + 1):
            h = 0
            for c in padded[k : k + n]:
                h = (h * 0x01000193 + ord(c)) & 0xFFFFFFFF
            h ^= n * 0x9E3779B1 & 0xFFFFFFFF
            h = (h ^ h >> 16) * 0x85EBCA6B & 0xFFFFFFFF
            h = (h ^ h >> 13) * 0xC2B2AE35 & 0xFFFFFFFF
            buckets.add(h >> 32 - tx.BITS)
    z = model.bias + sum(weight.get(b, 0.0) for b in buckets)
    return 1 / (1 + math.exp(-max(-500, min(500, z))))


def test_scores_are_sums_over_ngrams(spark, corpus, awkward):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    model = tx.train_model(corpus, labels)
    assert len(model.buckets) > 100
    rows = [(r["doc_id"], r["text"]) for r in corpus.collect()][:60]
    got = {r["doc_id"]: r["score"] for r in tx.score_toxicity(corpus, model).collect()}
    assert all(math.isclose(got[i], plain_score(model, t), rel_tol=1e-9, abs_tol=1e-12) for i, t in rows)
    want = sorted(round(plain_score(model, t), 9) for _, t, *_ in awkward_rows())
    assert sorted(round(r["score"], 9) for r in tx.score_toxicity(awkward, model).collect()) == want


def test_scores_awkward(spark, awkward, empty):
    labels = spark.createDataFrame([(5, 1, 1), (6, 0, 1), (8, 0, 0), (9, 0, 0), (None, 0, 1), (11, 0, None)], "doc_id long, quality int, toxic int")
    got = tx.score_toxicity(awkward, tx.train_model(awkward, labels)).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in awkward_rows())
    for r in got:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
    assert tx.score_toxicity(empty, tx.train_model(empty, labels.limit(0))).collect() == []


def test_held_out_labels_do_not_matter_and_accuracy(spark):
    from platelake.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in QUERIES["op3_toxicity"](spark, sf).collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    flipped = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(doc_id AS STRING)) % 3 = 1 THEN 1 - toxic ELSE toxic END AS toxic")
    other = {r["doc_id"]: r["score"] for r in tx.score_toxicity(docs, tx.train_model(docs, flipped)).collect()}
    assert all(abs(other[i] - r["score"]) < 1e-12 for i, r in got.items())
    test = [(got[r["doc_id"]]["score"], r["toxic"]) for r in labels.collect() if got[r["doc_id"]]["held_out"]]
    pos, neg = [s for s, t in test if t], [s for s, t in test if not t]
    auc = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    assert auc > 0.85
    assert np.mean([n >= 0.7 for n in neg]) < 0.05
