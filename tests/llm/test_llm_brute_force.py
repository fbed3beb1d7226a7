"""The operators held against plain Python, and their rows against awkward ids."""

import hashlib
import math
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from hypsogrid.llm import attention_lm, bpe, decontaminate, jaccard_join, language_id, quality_lm, quality_rules, sharding
from test_llm_operators import docs_of

BIG = 9007199254740993  # 2**53 + 1 and 2**53 + 3 are no floats


def big_docs(spark):
    words = [f"w{k}" for k in range(60)]
    text = " ".join(words)
    rows = [(BIG, text, "en"), (BIG + 2, text, "en"), (None, text + " and an end", "de"), (None, None, None), (BIG + 4, "Zwei ganz andere Worte stehen hier " * 12, "de")]
    return docs_of(spark, rows).withColumn("item", F.lit("clash")).withColumn("_row", F.lit(1)).withColumn("key", F.lit(2)).coalesce(1)


def tables(spark):
    labels = spark.createDataFrame([(BIG, 1, 0), (BIG + 2, 1, 0), (BIG + 4, 0, 0)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(BIG, " ".join(f"w{k}" for k in range(20, 50))), (BIG, " ".join(f"w{k}" for k in range(20, 50))), (None, None)], "item_id long, text string")
    return labels, bench


def ids(df):
    return sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in df.collect())


def test_ids_beyond_floats_beside_null(spark):
    docs, (labels, bench) = big_docs(spark), tables(spark)
    want = ids(docs)
    for df in (
        bpe.round_trip(docs), quality_lm.classify(docs, labels), jaccard_join.link_documents(docs), attention_lm.score_documents(docs),
        quality_rules.judge_documents(docs), sharding.shard_documents(docs), language_id.identify(docs),
    ):
        assert ids(df) == want
    both = [sorted(((r["doc_id"], r["item_id"]) for r in decontaminate.find(docs, bench, n).collect()), key=str) for n in (10**6, 0)]
    assert both[0] == both[1] == sorted([(BIG, BIG), (BIG, BIG), (BIG + 2, BIG), (BIG + 2, BIG), (None, BIG), (None, BIG)], key=str)


@pytest.mark.parametrize("empty", [False, True])
def test_stages_keep_columns_and_ids(spark, empty):
    docs, (labels, bench) = big_docs(spark), tables(spark)
    docs = docs.limit(0) if empty else docs
    labels, bench = (labels.limit(0), bench.limit(0)) if empty else (labels, bench)
    rows = {tuple(r) for r in docs.collect()}
    for df, left in (
        (quality_lm.keep_good(docs, labels), None), (quality_rules.keep_passing(docs), None), (jaccard_join.keep_one(docs), [BIG, BIG + 4, None]),
        (decontaminate.drop_contaminated(docs, bench), [BIG + 4, None]), (decontaminate.drop_contaminated(docs, bench, 0), [BIG + 4, None]),
    ):
        assert df.columns == docs.columns
        got = df.collect()
        assert {tuple(r) for r in got} <= rows
        if left is not None and not empty:
            assert sorted(map(str, (r["doc_id"] for r in got))) == sorted(map(str, left))


def test_bpe_query_is_that_of_the_library(spark, sf_dir):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.Encoder(public_tokenizers.path(bpe.VOCABULARY)).ranks, special_tokens={})
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    for r in bpe.round_trip(docs).collect():
        own = library.encode_ordinary(text[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"]) == (len(own), hashlib.sha256(np.array(own, "<u4").tobytes()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(text[r["doc_id"]].encode()).hexdigest()


def kneser_ney(texts, order):
    """log-probability of a text by interpolated modified Kneser-Ney, by the book: counts of the longest n-grams, and
    for shorter ones the number of different bytes before them."""
    counts = [Counter() for _ in range(order + 1)]
    padded = lambda t: b"\n" * (order - 1) + t.encode() + b"\n"
    for t in texts:
        raw = padded(t)
        counts[order].update(raw[i - order : i] for i in range(order, len(raw) + 1))
    for n in range(order - 1, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    cuts, contexts = {}, [defaultdict(list) for _ in range(order + 1)]
    for n in range(1, order + 1):
        of = [sum(c == k for c in counts[n].values()) for k in range(5)]
        y = of[1] / max(of[1] + 2 * of[2], 1)
        raw_cuts = [1 - 2 * y * of[2] / max(of[1], 1), 2 - 3 * y * of[3] / max(of[2], 1), 3 - 4 * y * of[4] / max(of[3], 1)]
        cuts[n] = [min(max(x, 0.1), k + 0.9) for k, x in enumerate(raw_cuts)]
        for g, c in counts[n].items():
            contexts[n][g[:-1]].append(c)

    def p(gram):
        n = len(gram)
        if not n:
            return 1 / 256
        seen = contexts[n].get(gram[:-1])
        if not seen:
            return p(gram[1:])
        cut = lambda c: cuts[n][min(c, 3) - 1] if c else 0
        c = counts[n].get(gram, 0)
        return (c - cut(c)) / sum(seen) + sum(map(cut, seen)) / sum(seen) * p(gram[1:])

    return lambda t: sum(math.log(p(padded(t)[i - order : i])) for i in range(order, len(padded(t)) + 1))


def test_quality_model_by_the_book(spark):
    rng = np.random.default_rng(3)
    some = [" ".join(rng.choice(["the", "cat", "sat", "on", "a", "mat", "größe"], 12)) for _ in range(60)]
    docs = docs_of(spark, [(i, t, "en") for i, t in enumerate(some)] + [(100, "xyzzy", "en"), (101, "", "en")])
    labels = spark.createDataFrame([(i, 1, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    fitted = {r["doc_id"] for r in quality_lm.trusted_ids(labels).where(~quality_lm._kept_out()).collect()}
    book = kneser_ney([some[i] for i in sorted(fitted)], quality_lm.ORDER)
    for r in quality_lm.score(docs, quality_lm.train(docs, labels)).collect():
        assert r["n_bytes"] == len(r["text"].encode()) and abs(r["log_p"] - book(r["text"])) < 1e-6 * abs(r["log_p"])


def feistel_by_hand(value, n, seed=0):
    bits = max(2, (n - 1).bit_length())
    low, high = bits // 2, -(-bits // 2)
    prime, m = sharding.PRIME, sharding.MULTIPLIERS
    while True:
        for k in range(sharding.ROUNDS):
            mixed = lambda half: (((half % prime + (seed * 7919 + 104729 * (k + 1)) % prime) % prime * m[k % 6] + 12345) % 4294967291 % prime * m[(k + 2) % 6] + 54321) % prime  # noqa: E731, B023
            if k % 2:
                value ^= mixed(value >> low) & (1 << low) - 1
            else:
                value ^= (mixed(value & (1 << low) - 1) & (1 << high) - 1) << low
        if value < n:
            return value


def spark_hash(*numbers):
    seed = 42
    for x in numbers:
        seed = xxhash.xxh64(int(x).to_bytes(8, "little", signed=True), seed).intdigest()
    return seed - (1 << 64 if seed >> 63 else 0)


def test_shards_by_hand(spark):
    docs = docs_of(spark, [(i % 90, "t" * (i % 7), "en") for i in range(400)])
    rows = [(r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in sharding.shard_documents(docs).collect()]
    keys = sorted((r[:3] for r in rows), key=lambda k: (spark_hash(*k) % sharding.BUCKETS, k))
    want = []
    for number, key in enumerate(keys):
        at = feistel_by_hand(number, len(keys))
        want.append((*key, at % 16, at // 16))
    assert sorted(rows) == sorted(want)


def test_language_gradients_numerically():
    rng = np.random.default_rng(0)
    model = language_id.ByteGRU(["a", "b", "c"], hidden=3)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    steps = language_id.CHUNK + 2 * language_id.CONTEXT
    chunks, length, label = rng.integers(0, 256, (steps, 3)).astype(np.uint8), np.array([5, 9, 7]), np.array([0, 2, 1])

    def loss():
        x = chunks[language_id.CONTEXT : language_id.CONTEXT + language_id.CHUNK].astype(np.intp)
        both = [np.stack([s.T.copy() for s in model._states(d, b)]) for d, b in (("f", x), ("b", x[::-1]))]
        e = np.concatenate([both[0], both[1][::-1]], 2) @ model.p["w"] + model.p["c"]
        e = e - np.log(np.exp(e).sum(2, keepdims=True))
        mask = np.arange(language_id.CHUNK)[:, None] < length
        return -(e[:, np.arange(3), label] * mask).sum() / mask.sum()

    before = {k: v.copy() for k, v in model.p.items()}
    model.fit(chunks, length, label, epochs=1, batch=3, rate=1e-5)
    for k, v in before.items():  # the first step of Adam goes against the gradient's sign, by the rate
        for at in (np.unravel_index(i, v.shape) for i in rng.choice(v.size, 6)):
            step = model.p[k][at] - v[at]
            kept = model.p
            model.p = {n: x.copy() for n, x in before.items()}
            model.p[k][at] += 1e-3
            up = loss()
            model.p[k][at] -= 2e-3
            slope = (up - loss()) / 2e-3
            model.p = kept
            assert abs(slope) < 1e-4 or np.sign(slope) == -np.sign(step)


def test_shingles_of_few_words():
    """Batches of fewer words than a shingle has, down to none."""
    for n in range(6):
        assert [len(s) for s in jaccard_join.shingle_sets([" ".join("abcdef"[:n])])] == [min(n, 1)]


def test_jaccard_recall_on_documents(spark, sf_dir):
    """Rows whose id is divisible by 100 against all rows: links by brute force are found."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    sets = {i: set(s.tolist()) for i, s in zip(text, jaccard_join.shingle_sets(list(text.values())))}
    got = {r["doc_id"]: r["n_links"] for r in jaccard_join.link_documents(docs).collect()}
    some = [i for i in text if i % 100 == 0 or got[i] > 0]
    want = {i: sum(j != i and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9 for j in text) if sets[i] else 0 for i in some}
    assert sum(got[i] for i in some) >= 0.99 * sum(want.values()) and all(got[i] <= want[i] for i in some)
