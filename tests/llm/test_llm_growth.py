"""Work that grows in proportion: equal rows, long dialogues, large pages."""

import gzip
import random
import subprocess
import sys
from pathlib import Path

import numpy as np

from pyspark.sql import functions as F

from hypsogrid.llm import attention_lm, chat, language_id, sharding, shared, warc


def test_equal_rows_are_split(spark):
    df = spark.range(5000).select(F.lit(7).alias("k")).union(spark.range(900).select((F.col("id") % 300).cast("int").alias("k")))
    numbered = sharding.number_rows(df, ["k"], buckets=64, copies=100)
    rows = numbered.collect()
    assert sorted(r["row_number"] for r in rows) == list(range(5900)) and {r["n_rows"] for r in rows} == {5900}
    runs = sorted(r["row_number"] for r in rows if r["k"] == 7)
    assert sum(b != a + 1 for a, b in zip(runs, runs[1:])) > 10  # not one run: its parts are in several buckets
    assert sharding.number_rows(df.limit(0), ["k"]).count() == 0
    placed = sharding.shard_rows(df, ["k"], 7).collect()
    assert sorted(r["position"] for r in placed) == list(range(5900))


def test_walks_that_go_on(spark):
    """One step at first leaves many rows to walk on; the permutation is the same."""
    df = spark.range(1000).select(F.col("id").alias("row_number"), F.lit(1000).cast("long").alias("n_rows"))
    got = [r["p"] for r in sharding.permute(df, "row_number", "n_rows", "p").orderBy("row_number").collect()]
    before = sharding.FIRST_STEPS
    try:
        sharding.FIRST_STEPS = 1
        again = [r["p"] for r in sharding.permute(df, "row_number", "n_rows", "p").orderBy("row_number").collect()]
    finally:
        sharding.FIRST_STEPS = before
    assert got == again and sorted(got) == list(range(1000))


def test_long_dialogues_of_many_speakers(spark):
    rng = random.Random(4)
    for n in (chat.RUN - 1, chat.RUN, chat.RUN + 1, 3 * chat.RUN + 17):
        said = [(1, i, rng.choice(["a", "b", "system", "käthe"]), "wört " * rng.randrange(4)) for i in range(n)]
        for r in chat.perspectives(spark.createDataFrame(said, "conv_id long, turn long, role string, text string")).collect():
            want = [t + chat.END for _, _, who, t in said if who == r["perspective"]]
            assert [r["text"][a:b] for a, b in r["spans"]] == want and r["n_own_turns"] == len(want)
    many = spark.createDataFrame([(2, i, f"p{i}", f"text {i}") for i in range(120)], "conv_id long, turn long, role string, text string")
    got = chat.perspectives(many)
    assert got.count() == 120 and got.where("size(spans) = 1").count() == 120


def test_large_pages_share_few_files(spark, tmp_path):
    pages = [(i, f"http://x/{i}", ("%06d" % (i % 20)) * (200_000 if i % 3 == 0 else 10)) for i in range(40)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1)
    path = f"file://{tmp_path}/archive"
    assert warc.write_pages(df, path, file_bytes=4 << 20) == 3
    files = sorted((tmp_path / "archive").glob("*.gz"))
    assert len(files) == 14 and max(len(gzip.decompress(f.read_bytes())) for f in files) <= 4 << 20
    assert {r["page_id"] for r in warc.read_archive(spark, path).collect()} == set(range(40))
    assert warc.records_per_file(None) == warc.RECORDS_PER_FILE and warc.records_per_file(1 << 40) == 1
    got = {r["page_id"]: r for r in warc.archive_pages(df).collect()}
    first = {html: min(i for i, _, h in pages if h == html) for _, _, html in pages}
    assert {i: r["refers_to"] for i, r in got.items()} == {i: None if first[html] == i else first[html] for i, _, html in pages}
    assert sum(r["record_type"] == "response" for r in got.values()) == len({p[2] for p in pages})


def by_byte(model, text):
    """A document's label probabilities, state after state and byte after byte, from the weights alone."""
    p, h = {k: v.astype(float) for k, v in model.p.items()}, model.h
    half = lambda v: 1 / (1 + np.exp(-2 * v))

    def states(d, bytes_):
        state, out = np.zeros(h), []
        for b in bytes_:
            x, a = p["table" + d][b], state @ p["u" + d]
            z, r = half(x[:h] + a[:h]), half(x[h : 2 * h] + a[h : 2 * h])
            n = np.tanh(r * a[2 * h :] + x[2 * h :])
            state = z * state + (1 - z) * n
            out.append(state)
        return out

    own, chunk, lead = list(text.encode()), language_id.CHUNK, language_id.CONTEXT
    padded, total = [10] * lead + own + [10] * (chunk + lead), np.zeros(len(model.labels))
    for k in range(0, len(own), chunk):
        part = padded[k : k + chunk + 2 * lead]
        forth, back = states("f", part[: chunk + lead])[lead:], states("b", part[lead:][::-1])[::-1]
        for t in range(min(chunk, len(own) - k)):
            e = np.exp(np.concatenate([forth[t], back[t]]) @ p["w"] + p["c"])
            total += e / e.sum()
    return total / len(own)


def test_language_probabilities_byte_by_byte(spark):
    model = language_id.ByteGRU(["de", "en", "fr"], seed=3)
    texts = ["a", "ü", "one two", "x" * language_id.CHUNK, "ab " * 65 + "ç", "Ärger " * 150, None, "", "12 !?"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    for r in language_id.predict(docs, model).collect():
        text = texts[r["doc_id"]]
        if not text or not any(c.isalpha() for c in text):
            assert (r["lang_pred"], r["score"]) == (language_id.UNKNOWN, 0.0)
            continue
        want = by_byte(model, text)
        assert r["lang_pred"] == model.labels[want.argmax()] and abs(r["score"] - want.max()) < 1e-4


def test_new_words_are_encoded_at_once():
    """The ids of each word alone, by few calls, also where words take each other's slots and hold odd white space."""
    rng = random.Random(5)
    odd = ["\u00a0", "x\u00a0", "\u2003y", "a\u00a0b", "\x1c", "'s", "don't", "\ufffd", "漢字", "e\u0301", "12ab", "\ud800"]
    plain = ["".join(rng.choice("abé1'.") for _ in range(rng.randrange(1, 9))) for _ in range(3000)]
    slots = attention_lm._SLOTS
    encode = attention_lm._encoding(attention_lm.VOCABULARY).encode_ordinary
    for number, of_words in ((slots, plain), (64, plain + odd), (slots, odd * 3)):
        attention_lm._SLOTS = number
        try:
            attention_lm._subwords.cache_clear()
            found, calls = attention_lm._subwords(attention_lm.VOCABULARY), []
            found.encode = lambda text, calls=calls: calls.append(1) or encode(text)
            texts = [" ".join(rng.choices(of_words, k=50)) for _ in range(100)] + ["", " \t "]
            for part in (texts, texts[::-1]):
                ids, size = attention_lm._tokens(part, attention_lm.VOCABULARY)[3:5]
                each = [w.encode("utf-8", "surrogatepass").decode("utf-8", "replace") for t in part for w in [*t.replace("\t", " ").split(" "), "\n"] if w]
        finally:
            attention_lm._SLOTS = slots
            attention_lm._subwords.cache_clear()
        want, n = [], []
        for t in part:
            own = [i for w in t.replace("\t", " ").split(" ") if w for i in encode(" " + w.encode("utf-8", "surrogatepass").decode("utf-8", "replace"))] + [attention_lm.END]
            want += own
            n.append(len(own))
        assert ids.tolist() == want and size.tolist() == n
        assert of_words is not plain or len(calls) <= 2


def test_steps_of_training_reuse_memory():
    """A step asked the system for its arrays anew: some 8 page faults a window, a third of its time."""
    code = """
import resource
import numpy as np
from hypsogrid.llm import attention_lm as lm
rng = np.random.default_rng(0)
keys, targets = (rng.integers(0, lm.CLASSES, (5120, n), np.uint8) for n in (32, 16))
m = lm.Attention(np.ones(lm.CLASSES))
m.fit(keys[:512], targets[:512], np.ones(512), 0.02)
before = resource.getrusage(resource.RUSAGE_SELF).ru_minflt
m.fit(keys, targets, np.ones(5120), 0.02)
print((resource.getrusage(resource.RUSAGE_SELF).ru_minflt - before) / 5120)
"""
    run = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).parents[2], capture_output=True, text=True, timeout=120, check=True)
    assert float(run.stdout) < 2


def test_kept_texts_are_compressed(spark):
    rng = np.random.default_rng(1)
    ids = [(rng.integers(0, 64, 4000).astype("<u2") ** 2 % 50000).astype("<u2").tobytes() for _ in range(50)]
    df = spark.createDataFrame([(x,) for x in ids], "ids binary").coalesce(1)
    sizes = []
    for codec in (None, "zstd"):
        kept = shared.keep(df, "sizes", codec)
        sizes.append(sum(f.stat().st_size for f in Path(kept._kept_at.removeprefix("file:").replace("//", "/", 1)).glob("*.parquet")))
        assert sorted(bytes(r["ids"]) for r in kept.collect()) == sorted(ids)
        shared.discard(kept)
    assert sizes[1] < 0.8 * sizes[0]
