import base64
import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from hypsogrid.llm import attention_lm, bpe, chat, components, decontaminate, jaccard_join, language_id, quality_lm, quality_rules, sharding, warc
from hypsogrid.llm.registry import ORACLES, QUERIES
from oracle import same

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in rows], DOCS)


def odd_docs(spark):
    long = " ".join(f"word{i % 977}x{i}" for i in range(30_000))
    return docs_of(spark, [(1, None, None), (2, "", "en"), (3, " \n\t", "en"), (None, "a few words only", "en"), (4, long, "de"), (4, long, "de"), (5, "¡años, 漢字 \U0001f600!", "es")])


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, sf_dir, name):
    same(QUERIES[name](spark, sf_dir), ORACLES[name], sf_dir)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op6_warc_revisits", "op7_perspective_rotation", "op11_conversation_prefix_trie"}))
@pytest.mark.parametrize("some", [True, False])
def test_odd_and_empty_documents(spark, tmp_path, name, some):
    docs = odd_docs(spark) if some else odd_docs(spark).limit(0)
    docs.withColumn("score", F.lit("clash")).withColumn("key", F.lit(1)).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(5, 1, 0), (None, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, None), (2, "")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = QUERIES[name](spark, str(tmp_path)).collect()
    assert len(got) == (0 if name.startswith("op5") else 7 * some)


def test_bpe_is_that_of_the_library(spark, sf_dir):
    with open(public_tokenizers.path(bpe.VOCABULARY), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    own = bpe.Encoder(public_tokenizers.path(bpe.VOCABULARY))
    texts = [r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()] + ["", "\x1c\x1d a", "x" * 5000, "aßé́ 漢字　\U0001f600", "12 345  \n\n  b"]
    for t in texts:
        ids = np.frombuffer(own.encode(t), "<u4").tolist()
        assert ids == library.encode_ordinary(t or "")
        assert bpe.Decoder(public_tokenizers.path(bpe.VOCABULARY)).decode(own.encode(t)) == (t or "").encode()


def _links(texts):
    """Brute force: sets of five-word windows, similarity of all pairs."""
    sets = []
    for t in texts:
        w = "".join(c.lower() if c.isascii() else c for c in t or "").split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    n = len(texts)
    return [[i != j and bool(sets[i]) and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9 for j in range(n)] for i in range(n)]


def test_jaccard_join_is_brute_force(spark):
    rng = np.random.default_rng(0)
    texts = []
    for g in range(12):
        words = [f"w{x}" for x in rng.integers(0, 5000, 120)]
        for _ in range(g):
            copy = list(words)
            for k in rng.integers(0, 120, rng.integers(0, 5)):
                copy[k] = "changed"
            texts.append(" ".join(copy))
    texts += ["short text", "short  TEXT", "", None]
    links = _links(texts)
    group = list(range(len(texts)))
    for _ in texts:
        group = [min([group[i], *(group[j] for j in range(len(texts)) if links[i][j])]) for i in range(len(texts))]
    docs = docs_of(spark, [(i, t, "en") for i, t in enumerate(texts)])
    got = {r["doc_id"]: r for r in jaccard_join.link_documents(docs, leaf=8).collect()}
    assert [got[i]["n_links"] for i in range(len(texts))] == [sum(x) for x in links]
    assert [got[i]["class_id"] for i in range(len(texts))] == group
    kept = {r["doc_id"] for r in jaccard_join.keep_one(docs.unionByName(docs.limit(3))).collect()}
    assert kept == set(group)


def test_components(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 102), (101, 102), (7, 7)]
    got = dict(tuple(r) for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(51)}, 100: 100, 101: 100, 102: 100}


def test_attention_gradients():
    rng = np.random.default_rng(0)
    m = attention_lm.Attention(np.ones(attention_lm.CLASSES))
    m.p = {k: v.astype(np.float64) for k, v in m.p.items()}
    keys, t = rng.integers(0, attention_lm.CLASSES, (3, 32)).astype(np.uint8), rng.integers(0, attention_lm.CLASSES, (3, 16)).astype(np.uint8)
    keys[0, :16], t[2, 9:] = attention_lm.NONE, attention_lm.NONE
    weight = np.array([1.0, 3.0, 2.0])
    each = (t != attention_lm.NONE) * weight[:, None]
    loss = lambda: -(m.log_p(keys, t)[0] * each).sum() / each.sum()
    for n, g in m.gradients(keys, t, weight).items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        m.p[n][at] += 1e-4
        up = loss()
        m.p[n][at] -= 2e-4
        assert abs((up - loss()) / 2e-4 - g[at]) < 1e-4
        m.p[n][at] += 1e-4


def test_attention_is_causal():
    rng = np.random.default_rng(0)
    m = attention_lm.Attention(np.ones(attention_lm.CLASSES))
    keys, t = rng.integers(0, attention_lm.CLASSES, (1, 32)).astype(np.uint8), rng.integers(0, attention_lm.CLASSES, (1, 16)).astype(np.uint8)
    other = keys.copy()
    other[0, 24:] = 3
    a, b = m.log_p(keys, t)[0][0], m.log_p(other, t)[0][0]
    assert np.allclose(a[:8], b[:8]) and not np.allclose(a[8:], b[8:])


def test_network_trains_on_every_window_once(spark):
    lm = attention_lm
    texts = [f"Word{i} and the {i % 5} others of " * (1 + 40 * (i % 41)) for i in range(45)] + ["the same text twice"] * 2
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    found = lm.read(docs).localCheckpoint()
    ids = [[i for w in t.lower().split() for i in lm._encoding(lm.VOCABULARY).encode_ordinary(" " + w)] + [lm.END] for t in texts]
    assert max(map(len, ids)) > 2 * lm.PART
    cl = lm._Classes(np.bincount(np.concatenate(ids), minlength=lm.END + 1))
    rows = found.where("kind = 'x'").collect()
    got = [lm._windows(cl.of[np.frombuffer(r["ids"], "<u2")], r["key"], int(cl.of[lm.END])) for r in rows]
    inputs, targets, _ = lm._blocks(cl.of[np.concatenate(ids)], np.array(list(map(len, ids))), int(cl.of[lm.END]))
    lead = np.flatnonzero(inputs[:, 0] != lm.NONE)
    want = np.concatenate([inputs[lead - 1], inputs[lead], targets[lead]], 1)
    assert sorted(map(bytes, want)) == sorted(bytes(w) for k, t in got for w in np.concatenate([k, t], 1))
    dealt = [d for r in range(lm.ROUNDS) for d in lm._dealt(found.where("kind = 'x'").select("ids", "key"), r, lm.ROUNDS, 4).collect()]
    assert len({d["ids"] for d in dealt}) == len(dealt) and sum(d["n"] for d in dealt) == len(rows)
    assert len([d for d in dealt if d["n"] == 2]) == 1


def test_rows_are_dealt_as_classes_and_copies_as_few(spark):
    lm = attention_lm
    ids = [np.arange(k, k + 50, dtype="<u2").tobytes() for k in range(3)]
    rows = spark.createDataFrame([(i, 0) for i in ids * 200], "ids binary, key long").coalesce(1)
    of = np.arange(lm.END + 1) % 192
    held = spark.sparkContext.broadcast(of.astype(np.uint8))
    narrow = lm._narrow(rows, held)
    assert narrow.count() == 3
    got = {bytes(r["ids"]): r["n"] for k in range(2) for r in lm._dealt(rows, k, 2, 4, lambda own: lm._narrow(own, held)).collect()}
    assert got == {bytes(range(k, k + 50)): 200 for k in range(3)}


def _softmax(x):
    e = np.exp(x - x.max())
    return e / e.sum()


def _score_by_hand(model, text, counts):
    """The score of one text, id by id and word by word, from the weights and the counts of words alone."""
    p, cl, size = {k: v.astype(np.float64) for k, v in model.net.p.items()}, model.classes, attention_lm.BLOCK
    encode = attention_lm._encoding(model.vocabulary).encode_ordinary
    words = [encode(" " + w) for w in text.lower().split()]
    ids = [*(i for w in words for i in w), attention_lm.END]
    before = [attention_lm.END, *ids[:-1]]
    begin, own = [], []
    for t in range(len(ids)):
        keys = [int(cl.of[before[j]]) for j in range(max(0, (t // size - 1) * size), t + 1)]
        q = p["q"][keys[-1]]
        a = _softmax(np.array([q @ p["k"][k] + p["near"][len(keys) - 1 - j] for j, k in enumerate(keys)]))
        h = np.maximum(sum(x * p["v"][k] for x, k in zip(a, keys)) @ p["o"] + p["e"][keys[-1]], 0)
        start = 1 / (1 + np.exp(-(h @ p["z"] + p["y"][0])))
        c, n = int(cl.of[ids[t]]), cl.begins
        low, high = (0, n) if c < n else (n, attention_lm.CLASSES)
        among = _softmax(h @ p["w"][:, low:high] + p["b"][low:high])[c - low] * np.exp(cl.within[ids[t]])
        begin.append(start)
        own.append(among if c < n else among * (1 - start))
    total, t = 0.0, 0
    for w, word in zip(words, text.lower().split()):
        spelled = np.prod([own[t + k] for k in range(1, len(w))]) * begin[t + len(w)]
        first = sum(c for x, c in counts.items() if encode(" " + x)[0] == w[0]), sum(encode(" " + x)[0] == w[0] for x in counts)
        below = first[0] + first[1] + 1
        total += np.log10(own[t] * (counts.get(word, 0) / below + (1 - first[0] / below) * spelled))
        t += len(w)
    return total + np.log10(own[t])


def test_scores_by_hand_with_few_words_broadcast(spark):
    text = lambda i: f"The cat number {i % 7} and a dog{i} " + "of the house " * (i % 9)
    docs = docs_of(spark, [(i, text(i), "en") for i in range(60)])
    counts: dict[str, int] = {}
    for i in range(60):
        for w in text(i).lower().split() + ["</end>"] if zlib.crc32(str(i).encode()) % 5 != 1 else []:
            counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    rows = [{r["doc_id"]: r for r in attention_lm.score_documents(docs, model_words=k).collect()} for k in (4, 10**6)]
    model = attention_lm.fit(docs.where(~attention_lm.held_out()))
    of_words = {w: c for w, c in counts.items() if w != "</end>"}
    for i in range(60):
        words = text(i).lower().split() + ["</end>"]
        want = sum(np.log10((counts.get(w, 0) + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        score = _score_by_hand(model, text(i), of_words)
        for r in rows:
            got = r[i]
            assert abs(got["base_score"] - want) < 1e-6 and got["n_known"] == sum(w in counts for w in words)
            assert got["n_tokens"] == len(words) and got["train_tokens"] == n and abs(got["score"] - score) < 1e-4 * abs(score)


def test_language_gradients():
    m = language_id.ByteGRU(["a", "b"], hidden=3)
    chunks, length, text = language_id.cut(["hello world", "ça va très bien"])
    sums = m.pooled(chunks(0, 2), length)
    assert np.allclose(sums.sum(1), length, rtol=1e-4)
    fitted = language_id.ByteGRU(["a", "b"]).fit(chunks(0, 2), length, np.array([0, 1]), epochs=60)
    assert fitted.probabilities(["hello world", "ça va très bien"]).argmax(1).tolist() == [0, 1]


def test_languages_held_out(spark, sf_dir):
    got = language_id.identify(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    truth = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    rows = got.where("held_out and lang_pred <> 'und'").join(truth, "doc_id").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in rows) >= 0.9 * len(rows)


def test_warc_revisits(spark):
    rows = [(3, "u3", "x"), (1, "u1", "x"), (2, None, None), (5, "u5", "WARC/1.1\r\n\r\n"), (4, "u4", ""), (None, " u6 ", "x"), (1, "u7", "y"), (6, "u8", "y"), (6, "u8", "y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("file", F.lit("clash")).withColumn("payload", F.lit(1))
    found = warc.archive_pages(pages).collect()
    got = sorted(((r["page_id"], r["record_type"], r["refers_to"]) for r in found), key=str)
    assert got == sorted([(1, "response", None), (1, "response", None), (2, "response", None), (3, "revisit", 1), (4, "revisit", 2), (5, "response", None),
                          (None, "revisit", 1), (6, "revisit", 1), (6, "revisit", 1)], key=str)
    assert {r["payload_digest"] for r in found if r["page_id"] == 3} == {base64.b32encode(hashlib.sha1(b"x").digest()).decode()}
    assert warc.archive_pages(pages.limit(0)).collect() == []


def test_warc_revisits_of_an_earlier_crawl(spark, tmp_path):
    """An archive that already holds revisits is resolved again; payloads come back by digest."""
    a, b, c = (f"file://{tmp_path}/{x}" for x in "abc")
    warc.write_pages(spark.createDataFrame([(1, "u1", "x"), (2, "u2", "x"), (3, "u3", "z")], "page_id long, url string, html string"), a)
    warc.deduplicate(spark, a, b)
    warc.deduplicate(spark, b, c)
    ends = warc.with_payloads(warc.read_archive(spark, c, with_payload=True)).collect()
    assert sorted((r["page_id"], r["record_type"], r["refers_to"], r["payload"]) for r in ends if r["refers_to"] is None) == [(1, "response", None, "x"), (3, "response", None, "z")]
    assert [(r["page_id"], r["refers_to"], r["payload"]) for r in ends if r["record_type"] == "revisit"] == [(2, 1, "x")]


def test_decontamination_of_another_parameter(spark):
    item = "A train leaves Prague at 7 and covers 120 km in 3 hours before it stops near the old bridge again"
    docs = docs_of(spark, [(1, "Intro. " + item.replace("120", "260").replace("Prague", "Vienna") + " End.", "en"), (2, "Nothing of this kind is here at all, only a plain sentence of words.", "en")])
    bench = spark.createDataFrame([(9, item)], "item_id long, text string")
    assert [(r["doc_id"], r["item_id"]) for r in decontaminate.find(docs, bench).collect()] == [(1, 9)]
    assert [(r["doc_id"], r["item_id"]) for r in decontaminate.find(docs, bench, broadcast_windows=0).collect()] == [(1, 9)]
    assert [r["doc_id"] for r in decontaminate.drop_contaminated(docs, bench).collect()] == [2]


def found_by_both(docs, bench):
    """Rows of `find`, equal with broadcast and joined windows."""
    rows = [sorted(map(tuple, decontaminate.find(docs, bench, broadcast_windows=n).collect())) for n in (10**6, 0)]
    assert rows[0] == rows[1]
    return rows[0]


def test_decontamination_by_alignment(spark):
    twice = "Ann has 3 red apples in the old basket. Bob has 5 red apples in the old basket."
    item = "A train leaves Prague at 7 and covers 120 km in 3 hours before it stops near the old bridge again"
    other = [item.replace("120", str(n)).replace("7", str(n + 1)).replace("3 hours", f"{n + 2} hours") for n in (260, 390)]
    halves = item.replace("before it", "as one reads " + "and so on " * 9 + "before it")
    texts = [twice, f"{item}\n{other[0]}", f"{other[0]}\n{other[1]}", item.replace("covers", "then covers"), halves, "The old basket is here, a plain sentence of no item at all."]
    bench = spark.createDataFrame([(8, twice), (9, item)], "item_id long, text string")
    got = {(r[0], r[1]): r for r in found_by_both(docs_of(spark, [(i, t, "en") for i, t in enumerate(texts)]), bench)}
    assert sorted(got) == [(0, 8), (1, 9), (2, 9), (3, 9), (4, 9)]
    assert got[0, 8][4] == 0 and got[1, 9][4] == 0 and got[2, 9][4] == 3


def test_decontamination_word_for_word(spark):
    rng = np.random.default_rng(0)
    numbers = " ".join(map(str, rng.integers(0, 1000, 30)))
    german = "Dort legte Karl seine Äpfel und Birnen neben Brot und Käse auf Tische aus Holz"
    long = " ".join(f"w{x}" if x % 3 else f"word{'abcdefghij'[x % 10]}" for x in rng.integers(0, 5000, 250))
    texts = [
        f"Here: {numbers} and so on", german.lower().replace(" und ", "\n und "), "Before. " + " ".join(long.split()[80:180]) + " After.",
        "Seven?\n42, yes\nThen more", "He said 42, yes or no", " ".join(numbers.split()[:10]) + " are other numbers", "7 8 9 10 11",
    ]
    bench = spark.createDataFrame([(1, numbers), (2, german), (3, long), (4, "42 yes"), (5, "7 8 9 10 11")], "item_id long, text string")
    got = found_by_both(docs_of(spark, [(i, t, "en") for i, t in enumerate(texts)]), bench)
    assert [r[:2] for r in got] == [(0, 1), (1, 2), (2, 3), (3, 4), (6, 5)]


def test_shards(spark):
    docs = docs_of(spark, [(i % 40, "t", "en") for i in range(103)])
    rows = sharding.shard_documents(docs, 16).collect()
    by: dict[int, list] = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert sorted(len(x) for x in by.values()) == [6] * 9 + [7] * 7
    assert all(sorted(x) == list(range(len(x))) for x in by.values())


def test_ablation_of_nothing(spark):
    rows = quality_rules.ablation(quality_rules.ledger(docs_of(spark, []))).collect()
    assert {r["rule"] for r in rows} == set(quality_rules.RULES) and all(r["n_failed"] == r["n_only"] == r["n_kept"] == r["n_kept_without"] == 0 for r in rows)


def test_ablation(spark):
    led = quality_rules.ledger(docs_of(spark, [(1, "few words", "en"), (2, "good " + " ".join(f"word{i}" for i in range(80)), "en")]))
    got = {r["rule"]: r for r in quality_rules.ablation(led).collect()}
    assert got["few_words"]["n_failed"] == 1 and got["few_words"]["n_only"] == 1 and got["few_words"]["n_kept_without"] == 2


def test_quality_join_equals_broadcast(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    model = quality_lm.train(docs, labels, 50)
    few = docs.limit(20).select("doc_id", "text")
    a = {r["doc_id"]: r["log_p"] for r in quality_lm.score(few, model).collect()}
    b = {r["doc_id"]: r["log_p"] for r in quality_lm.score_by_join(few, model).collect()}
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-6 * abs(a[k]) for k in a)


def test_quality_recall_and_loss(spark):
    """Trusted texts of made-up words; junk of other words lies above the threshold, rule lines lie below the floor."""
    rng = np.random.default_rng(0)
    known = ["".join(rng.choice(list("abcdefghij"), rng.integers(2, 8))) for _ in range(400)]
    of = lambda vocabulary, n: " ".join(rng.choice(vocabulary, n))
    rows, labelled = [], []
    for i in range(600):
        own = [*known, *("".join(rng.choice(list("klmnopqrst"), 5)) for _ in range(int(rng.integers(0, 60))))]
        rows.append((i, of(own, 120) + "-" * 40, "en"))
        labelled.append((i, 1, 0))
    other = [*known[:200], *("".join(rng.choice(list("klmnopqrst"), 5)) for _ in range(70))]
    rows += [(1000 + i, of(other, 150), "en") for i in range(40)] + [(2000, "-" * 5000, "en")]
    got = {r["doc_id"]: r["kept"] for r in quality_lm.classify(docs_of(spark, rows), spark.createDataFrame(labelled, "doc_id long, quality int, toxic int")).collect()}
    assert sum(not got[i] for i in range(600)) <= 12
    assert sum(not got[1000 + i] for i in range(40)) >= 36 and not got[2000]


def test_quality_threshold_is_a_quantile(spark):
    rows = [(i, "en", 999, -1000 * (1.4 + 0.2 * i / 2000)) for i in range(2000)] + [(5000, "en", 9999, -17_500.0), (5001, "en", 9999, -5_000.0), (5002, "en", 9999, -15_900.0)]
    scored = spark.createDataFrame(rows, "doc_id long, lang string, n_bytes long, log_p double")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(2000)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r["kept"] for r in quality_lm.judge(scored, quality_lm.thresholds(scored, labels)).collect()}
    assert sum(not got[i] for i in range(2000)) <= 30
    assert (got[5000], got[5001], got[5002]) == (False, False, True)


def test_rotation_of_turns_that_tie(spark):
    turns = spark.createDataFrame(
        [(1, 0, "a", "x"), (1, 0, "b", "y"), (1, 0, "b", "y"), (1, 1, "system", None), (None, 0, None, "z"), (None, 0, "q|>", "<|end|>"), (3, None, "system", "s")],
        "conv_id long, turn int, role string, text string").withColumn("part", F.lit(1)).withColumn("said", F.lit("clash"))
    rows = {(r["conv_id"], r["perspective"]): r for r in chat.perspective_rows(turns).collect()}
    assert sorted(rows, key=str) == sorted([(1, "a"), (1, "b"), (None, "unknown"), (None, "q| >")], key=str)
    assert rows[1, "b"]["n_turns"] == 4 and rows[1, "b"]["n_own_turns"] == 2
    assert rows[None, "q| >"]["text"] == "<|assistant|>\n< |end|><|end|>\n"
    assert chat.perspective_rows(turns.limit(0)).collect() == []


def test_rotation_of_a_long_dialogue(spark):
    turns = spark.range(2000).selectExpr("7L as conv_id", "id as turn", "case when id = 0 then 'system' when id % 2 = 0 then 'a' else 'b' end as role", "concat('t', id) as text")
    for r in chat.perspectives(turns).collect():
        own = [r["text"][s["start"] : s["end"]] for s in r["spans"]]
        assert own == [f"t{i}<|end|>\n" for i in range(1, 2000) if (i % 2 == 0) == (r["perspective"] == "a")]
        assert r["text"].startswith("<|system|>\nt0<|end|>\n") and r["n_turns"] == 2000


def test_pipeline_stages(spark, sf_dir):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = p.run(spark, sf_dir)
    ids = {r["doc_id"] for r in out.collect()}
    assert 0.5 * docs.count() < len(ids) <= docs.count() and out.count() == len(ids)
    assert [n for n, _ in p.STAGES] == ["quality_classifier", "quality_rules", "jaccard_join", "decontamination", "byte_bpe"]
