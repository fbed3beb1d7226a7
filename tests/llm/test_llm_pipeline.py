"""The pipeline stage by stage: each stage's documents recomputed from what its predecessor kept, by other means where
there are some: rules by SQL, groups by all pairs of word sets, ids by the public library."""

import base64
import hashlib
import struct

import duckdb
import public_tokenizers
import tiktoken

import corpus_pipeline
from hypsogrid.llm import bpe, decontaminate, quality_lm, quality_rules


def kept_by_sql(docs):
    con = duckdb.connect()
    frame = docs.toPandas()  # noqa: F841
    con.execute("create view documents as select * from frame")
    out = con.execute(f"select doc_id, kept from ({quality_rules.ORACLE})").fetchall()
    return {i for i, kept in out if kept}


def one_of_each_group(rows):
    """doc_ids of rows (doc_id, text) that stay: of texts linked by 0.8 of their five-word sets the least doc_id."""
    sets = []
    for _, text in rows:
        w = "".join(c.lower() if c.isascii() else c for c in text or "").split()
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    group = list(range(len(rows)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    by_window = {}
    for i, s in enumerate(sets):
        for x in s:
            by_window.setdefault(x, []).append(i)
    for near in {(a, b) for members in by_window.values() for k, a in enumerate(members) for b in members[k + 1 :]}:
        a, b = (sets[i] for i in near)
        if len(a & b) >= 0.8 * len(a | b) - 1e-9:
            x, y = sorted(map(top, near))
            group[y] = x
    best = {}
    for i, (doc_id, _) in enumerate(rows):
        g = top(i)
        best[g] = min(best.get(g, doc_id), doc_id)
    return set(best.values())


def encoder():
    with open(public_tokenizers.path(bpe.VOCABULARY), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda t: library.encode_ordinary(t or "")


def test_every_stage_is_recomputed(spark, sf_dir):
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    stages, docs, kept = dict(corpus_pipeline.STAGES), read("documents"), []

    def run(name, docs):
        out = stages[name](spark, docs, sf_dir)
        rows = out.collect()
        kept.append({r["doc_id"] for r in rows})
        assert out.columns == read("documents").columns and len(kept[-1]) == len(rows)
        return spark.createDataFrame(rows, out.schema)

    good = run("quality_classifier", docs)
    judged = quality_lm.classify(docs, read("labels")).collect()
    assert kept[-1] == {r["doc_id"] for r in judged if r["kept"]}
    labels = {r["doc_id"]: r["quality"] for r in read("labels").collect()}
    trusted = [i for i, q in labels.items() if q == 1]
    assert sum(i in kept[-1] for i in trusted) >= 0.97 * len(trusted)

    passing = run("quality_rules", good)
    assert kept[-1] == kept_by_sql(good)

    single = run("jaccard_join", passing)
    assert kept[-1] == one_of_each_group([(r["doc_id"], r["text"]) for r in passing.collect()])

    clean = run("decontamination", single)
    found = {r["doc_id"] for r in decontaminate.find(single, read("benchmark")).collect()}
    assert kept[-1] == kept[-2] - found and found
    items = [" ".join(r["text"].split()).lower() for r in read("benchmark").collect()]
    for r in clean.collect():  # no item stands word for word in what is left
        text = " ".join((r["text"] or "").split()).lower()
        assert not any(len(i.split()) >= 13 and i in text for i in items)

    encode = encoder()
    texts = {r["doc_id"]: r["text"] for r in clean.collect()}
    final = {r["doc_id"]: r for r in stages["byte_bpe"](spark, clean, sf_dir).collect()}
    assert final.keys() == texts.keys()
    for i, r in final.items():
        ids = encode(texts[i])
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((texts[i] or "").encode()).hexdigest()
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, sf_dir).collect()} == final.keys()
