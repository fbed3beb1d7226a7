"""Merkle manifests, conversation tries and personal data, held against plain Python."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hypsogrid.llm import merkle, pii, prefix_trie
from oracle import same

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


# Merkle trees


def tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        at = levels[-1]
        levels.append([sha("".join(at[i : i + 2])) for i in range(0, len(at), 2)])
    return levels


@pytest.mark.parametrize("n", [*range(1, 35), 511, 1000])
def test_paths_and_memory(n):
    leaves = [sha(str(i)) for i in range(n)]
    levels, height = tree(leaves), (n - 1).bit_length()
    assert merkle.root(leaves, height) == levels[-1][0]
    got = list(merkle.paths(leaves, height))
    assert got == [[levels[k][(i >> k) ^ 1] if (i >> k) ^ 1 < len(levels[k]) else None for k in range(height)] for i in range(n)]


def by_hand(rows, tampered_of=7):
    """The contract's columns for rows (doc_id, text, lang, source, n_chars)."""

    def leaf(d, t, g, s, n):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (d, s, g, n, t)))

    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(*r), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in names}
    top = tree([trees[g][-1][0] for g in names])
    out = []
    for at, g in enumerate(names):
        for i, (_, _, own, r) in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % tampered_of == 0 and r[4] is not None
            folded, proof = leaf(*r[:4], r[4] + 1) if hit else own, ""
            for levels, k in ((trees[g], i), (top, at)):
                for level in levels[:-1]:
                    run = level[k // 2 * 2 : k // 2 * 2 + 2]
                    proof += "".join(x for j, x in enumerate(run) if j != k % 2)
                    run[k % 2] = folded
                    folded, k = sha("".join(run)), k // 2
            out.append((r[0], own, trees[g][-1][0], top[-1][0], sha(proof), folded, folded == top[-1][0]))
    return sorted(out, key=repr)


def test_manifest_by_hand(spark):
    rng = random.Random(3)
    langs = [None, "", "de", "en", "é", "z"]
    rows = [(i, f"text {i % 9} ü", rng.choice(langs[1:]), "s" if i % 3 else None, i) for i in range(150)]
    rows += [(None, None, None, None, None), (None, "", None, "", 0), (5, "other", "en", "s", 1), (2**63 - 1, "x" * 100_000, "z", "s", 2**63 - 1)]
    rows += [(77, "same", "de", "s", 4)] * 40  # equal rows, a fifth of all
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 as position", "'x' as leaf", "2 as n_group").repartition(5)
    for levels in (2, 10):
        got = sorted(map(tuple, merkle.prove_documents(docs, levels=levels).collect()), key=repr)
        assert got == by_hand(rows)


def test_manifest_edges(spark, sf_dir):
    assert merkle.prove_documents(spark.createDataFrame([], DOCS)).count() == 0
    one = merkle.prove_documents(spark.createDataFrame([(1, "a", "en", "s", 1)], DOCS)).first()
    assert one["leaf"] == one["subroot"] == one["root"] and one["proof_sha256"] == sha("")
    docs = spark.createDataFrame([(i, "a", "en", "s", 1) for i in range(9)], DOCS)
    proofs = merkle.verify(merkle.manifest(docs))
    assert proofs.where("verified").count() == 9
    assert merkle.verify(proofs.drop("folded_root", "verified").selectExpr("* except (index)", "index + 1 as index")).where("verified").count() < 9
    same(merkle.prove_documents(spark.read.parquet(f"{sf_dir}/documents.parquet")), merkle.ORACLE, sf_dir)


# tries


def brute_trie(talks):
    """talks: {conv: [(digest, words), ...]}"""
    members, below = {}, {}
    for c, said in talks.items():
        for d in range(len(said) + 1):
            members.setdefault(tuple(said[:d]), []).append(c)
    for k in members:
        if k:
            below.setdefault(k[:-1], set()).add(k)
    rows = []
    for k, m in members.items():
        sub = [u for u in members if u[: len(k)] == k]
        ends = ",".join(str(c) for c in sorted(m) if len(talks[c]) == len(k))
        rows.append((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(below.get(k, ())), sum(u not in below for u in sub),
                     sum((len(members[u]) - 1) * (u[-1][1] if u else 0) for u in sub), sha(ends)))
    return sorted(rows, key=repr)


def random_talks(rng, n, letters=3, most=6):
    turn = lambda: (lambda x: (sha(str(x))[:32], x))(rng.randrange(letters))
    talks = {c: [turn() for _ in range(rng.randrange(most))] for c in rng.sample(range(-50, 10 * n), n)}
    for c in list(talks)[: n // 3]:  # a third of all conversations are one
        talks[c] = [(sha("x")[:32], 7), (sha("y")[:32], 2)]
    return talks


@pytest.mark.parametrize("seed", range(30))
def test_sweeps_against_brute_force(monkeypatch, seed):
    """Small bounds, so that children are let go, members become rows, and ranges end anywhere."""
    monkeypatch.setattr(prefix_trie, "PENDING", 3)
    monkeypatch.setattr(prefix_trie, "CHUNK", 12)
    rng = random.Random(seed)
    talks = random_talks(rng, 40)
    rows = sorted((bytes.fromhex("".join(d for d, _ in said)), c, [w for _, w in said]) for c, said in talks.items())
    cuts = sorted(rng.sample(range(len(rows) + 1), 6))
    frames = []
    for s, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(rows)])):
        sweep = prefix_trie.Sweep(s)
        for key, conv, words in rows[a:b]:
            sweep.member(conv, key, words)
        sweep.finish()
        frames.append(sweep.taken())
    import pandas as pd

    found = pd.concat([f for f in frames if len(f)])
    every = [found]
    for fan, last in ((3, False), (3, True)):
        now = found[found["kind"] == "open"]
        found = pd.concat([prefix_trie._sweep_open(last, fan)(g) for _, g in now.groupby(now["segment"] // fan)])
        every.append(found)
    every = pd.concat(every)
    nodes, ends = every[every["kind"] == "node"], every[every["kind"] == "ends"].sort_values(["id", "segment", "seq"])
    hashed = dict(r for f in prefix_trie._hash_ends(iter([ends[:3], ends[3:]])) for r in zip(f["id"], f["_ends"]))
    wanted = {r.id: r.conv_id for r in nodes.itertuples() if r.waited_for}
    got = [(r.conv_id, r.depth, r.parent_conv_id if r.parent_id is None else wanted[r.parent_id], r.n_convs, r.n_children, r.n_leaves, r.saved_tokens,
            hashed[r.id] if r.in_rows else r.ends_sha256) for r in nodes.itertuples()]
    assert sorted(got, key=repr) == brute_trie(talks)


def test_trie_on_spark(spark):
    rng = random.Random(5)
    talks = random_talks(rng, 120)
    rows = [(c, [(None, d, w) for d, w in said]) for c, said in talks.items()]
    df = spark.createDataFrame(rows, "conv_id long, said array<struct<turn: long, digest: string, words: int>>")
    for fan in (2, 64):
        assert sorted(map(tuple, prefix_trie.nodes(df, fan).collect()), key=repr) == brute_trie(talks)


def test_conversations_rebuilt(spark, sf_dir):
    long_ = " ".join(["word"] * 5000)
    turns = [(c, t, r, x) for c in (0, 1, 5, 19, 20, 21, 39, 47) for t, r, x in ((None, "user", "hi there"), (1, None, f"a {c % 2}"), (2, "user", None), (2, "user", None), (3, "b", long_))]
    turns += [(None, 1, "user", "nobody"), (61, 0, None, None)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as depth", "'x' as said", "2 as id")
    talks = {}
    for c, t, r, x in turns:
        if c is not None:
            said = f"{len((r or '').encode())}:{r or ''}{x or ''}"
            talks.setdefault(c, []).append((t is not None, t or 0, sha(said)[:32], len(re.findall(r"[^\x20\x09-\x0D]+", x or ""))))
    talks = {c: [(d, w) for _, _, d, w in sorted(v)] for c, v in talks.items()}
    made = {}
    for c, said in talks.items():
        h = zlib.crc32(str(c).encode()) % 4
        made[c] = talks.get(c - c % 20, [])[:h] + said[h:]
    assert any(not v for v in made.values()) or all(made.values())
    assert sorted(map(tuple, prefix_trie.rebuilt_trie(df).collect()), key=repr) == brute_trie(made)
    assert prefix_trie.rebuilt_trie(df.limit(0)).count() == 0
    nodes = prefix_trie.with_last_turn(prefix_trie.nodes(prefix_trie.turn_arrays(df)), df)
    assert {(r["role"], r["text"]) for r in nodes.where("depth = 1").collect()} == {("user", "hi there"), ("", "")}
    same(prefix_trie.rebuilt_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet")), prefix_trie.ORACLE, sf_dir)


# personal data

_RULES = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
)


def rules(text):
    out = []
    for k, rule in enumerate(_RULES):
        for m in re.finditer(rule, text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = (True, k == 1 and all(int(p) <= 255 for p in m[0].split(".")), 14 <= len(digits) <= 19 and pii.luhn(digits), 10 <= len(digits) <= 15)[k]
            if ok:
                out.append((m.start(), k, m.end()))
    return sorted(out)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a._@+-0125 ()\né", max_size=60))
def test_rules_are_the_patterns(text):
    assert pii.base_spans(text) == rules(text)


def test_rules_are_linear():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "@a" * 100_000, "1 " * 150_000, "a.a@" * 60_000, "+1" * 100_000):
        pii.base_spans(text)
        pii.candidates(text)


def card(rng):
    digits = "4" + "".join(str(rng.randrange(10)) for _ in range(14))
    return next(digits + str(c) for c in range(10) if pii.luhn(digits + str(c)))


def some_docs(rng, n):
    word = lambda: "".join(rng.choice("abdeghinorst") for _ in range(rng.randrange(2, 9)))
    kinds = [lambda: f"{word()}.{rng.randrange(99)}@{word()}.com", lambda: ".".join(str(rng.randrange(256)) for _ in range(4)), lambda: card(rng),
             lambda: f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"]
    docs = []
    for i in range(n):
        words = [word() for _ in range(30)]
        if i % 2:
            words[10] = rng.choice(kinds)()
        if i % 7 == 0:
            words[20] = rng.choice([f"version {rng.randrange(9)}.{rng.randrange(9)}", f"token={rng.getrandbits(80):x}", str(rng.randrange(10**15, 10**16)), f"{rng.randrange(300, 900)}.1.2.3"])
        docs.append((i, " ".join(words)))
    return docs


def test_trees_add_what_rules_miss(spark):
    rng = random.Random(2)
    docs = some_docs(rng, 1500)
    model = pii.train(spark.createDataFrame(docs, "doc_id long, text string"))
    assert all(t < np.inf for t in model.thresholds)
    a, b = card(rng), "+1 (269) 555-3296"
    joined = f"see {b} {a} and more"
    clean = [t for _, t in some_docs(random.Random(9), 400) if not rules(t) and "  " not in t]
    texts = [joined, "write to ann.lee at mail dot example dot com now", "at home. Then 3 at a time", *clean]
    added = model.added(texts, [pii.base_spans(t) for t in texts])
    assert [(pii.KINDS[k], joined[x:y]) for x, k, y in sorted(added[0])] == [("phone", b), ("card", a)]
    assert [texts[1][x:y] for x, _, y in added[1]] == ["ann.lee at mail dot example dot com"]
    assert sum(map(len, added[2:])) <= len(clean) // 100
    held = some_docs(random.Random(4), 600)
    found = pii.find(spark.createDataFrame(held, "doc_id long, text string"), model).collect()
    assert all([(s["start"], pii.KINDS.index(s["kind"]), s["end"]) for s in r["pii"] if s["base"]] == rules(r["text"]) for r in found)


def test_pii_edges(spark):
    docs = spark.createDataFrame([(1, None, 1), (None, "", 1), (2, "x@y.zz", 1), (2, "x@y.zz", 1), (3, "ä 10.0.0.1 +1 555 123 4567 " + "q" * 200_000, 1)], "doc_id long, text string, pii int")
    got = sorted((tuple(r) for r in pii.find_documents(docs).collect()), key=repr)
    assert [r[:5] for r in got] == sorted([(1, 0, 0, 0, 0), (None, 0, 0, 0, 0), (2, 1, 0, 0, 0), (2, 1, 0, 0, 0), (3, 0, 1, 0, 1)], key=repr)
    spans = {r[0]: r[6] for r in got}
    assert spans[2] == "email:0:6" and spans[3] == "ip:2:10,phone:11:26" and spans[1] == ""
    assert {r[0]: r[5] for r in got}[3] == sha("ip:2:10,phone:11:26") and {r[0]: r[5] for r in got}[None] == sha("")
    red = {r["doc_id"]: r["redacted"] for r in pii.redact(pii.find(docs.drop("pii"), None)).collect()}
    assert red[2] == "[email]" and red[3].startswith("ä [ip] [phone] qqq") and red[1] is None
    assert pii.find_documents(docs.limit(0)).count() == 0


def test_isotonic_and_trees():
    x, p = pii.calibrated(np.array([1.0, 2, 3, 4]), np.array([0.0, 1, 0, 1]), np.ones(4))
    assert list(p) == [0, 0.5, 1] and list(x) == [1, 2, 4]
    rng = np.random.default_rng(0)
    data = rng.random((2000, 4))
    label = ((data[:, 0] > 0.5) ^ (data[:, 1] > 0.5)).astype(float)
    trees = pii.Trees().fit(data, label, np.ones(2000))
    assert ((trees.score(data) > 0) == label).mean() > 0.97
