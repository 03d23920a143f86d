"""PPM language identification: code lengths against a plain tree, held-out accuracy, edge rows."""

import math
import zlib
from collections import Counter

import numpy as np
from llm_fixtures import SMALL_SF, edge_docs, edge_rows, no_docs  # noqa: F401
from pyspark.sql import functions as F

from ticketlens.llm import language


def plain_bits(samples: list[str], text: str, order: int) -> float:
    """The same model, one byte and one context at a time."""
    counts = [Counter() for _ in range(order + 1)]
    for t in samples:
        data = b"\0" * order + language._bytes(t)
        for i in range(order, len(data)):
            for k in range(order + 1):
                counts[k][data[i - k : i + 1]] += 1
    total, distinct = [Counter() for _ in counts], [Counter() for _ in counts]
    for k, c in enumerate(counts):
        for gram, n in c.items():
            total[k][gram[:-1]] += n
            distinct[k][gram[:-1]] += 1
    data, bits = b"\0" * order + language._bytes(text), 0.0
    for i in range(order, len(data)):
        for k in range(order, -1, -1):
            context, gram = data[i - k : i], data[i - k : i + 1]
            n, d = total[k][context], distinct[k][context]
            if counts[k][gram]:
                bits -= math.log2(counts[k][gram] / (n + d))
                break
            if d:
                bits -= math.log2(d / (n + d))
        else:
            bits += 8
    return bits


def test_code_lengths_are_those_of_the_plain_tree():
    samples = {"aa": ["the cat sat on the mat", "a cat, a hat 12"], "bb": ["le chat est là", "été 7"]}
    model = language.fit(samples, 3)
    texts = ["the hat", "été là le", "zzz\n", "", "THE 99 cats", "日本"]
    got = language.code_lengths(model, texts)
    for i, t in enumerate(texts):
        for j, lang in enumerate(model.languages):
            assert abs(got[i, j] - plain_bits(samples[lang], t, 3)) < 1e-3


def test_long_texts_are_summed_in_blocks(monkeypatch):
    model = language.fit({"aa": ["abc abd abe"], "bb": ["xyz xya"]}, 4)
    text = "abc xyz abd é " * 50
    whole = language.code_lengths(model, [text])
    monkeypatch.setattr(language, "BLOCK_BYTES", 37)
    assert np.allclose(language.code_lengths(model, [text]), whole, rtol=1e-5)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SMALL_SF}/documents.parquet")
    found = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in found if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in found)
    assert sum(r["lang_pred"] == r["lang"] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in found)


def test_held_out_rows_and_other_columns_do_not_matter(spark):
    docs = spark.read.parquet(f"{SMALL_SF}/documents.parquet")
    changed = docs.withColumn("lang", F.when(language.held_out("doc_id"), F.lit("xx")).otherwise(F.col("lang")))
    changed = changed.withColumn("source", F.lit("other"))
    a, b = (sorted(map(tuple, language.identify(d).collect())) for d in (docs, changed))
    assert a == b


def test_edge_rows(edge_docs, edge_rows):
    found = language.identify(edge_docs).collect()
    assert len(found) == len(edge_rows)
    for r in found:
        if r["doc_id"] in (4, 5, 6):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        if r["doc_id"] is None:
            assert r["held_out"] is False
    kept = language.keep_identified(edge_docs)
    assert kept.columns == edge_docs.columns
    assert not {4, 5, 6} & {r["doc_id"] for r in kept.select("doc_id").collect()}


def test_nothing_labelled_and_empty(edge_docs, no_docs):
    unlabelled = edge_docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language.identify(unlabelled).collect()} == {"und"}
    assert language.identify(no_docs).collect() == []
    assert language.keep_identified(no_docs).collect() == []


def test_texts_that_no_tree_explains_are_rejected(spark):
    """Letters without a language and languages never learned go, documents stay."""
    rs = np.random.RandomState(4)
    docs = spark.read.parquet(f"{SMALL_SF}/documents.parquet").select("doc_id", "text", "lang")
    odd = [" ".join("".join(rs.choice(list("bcdfghjklmnpqrstvwxz"), rs.randint(2, 9))) for _ in range(60)) for _ in range(20)]
    odd += ["Это русский текст, который не входит в число изученных языков.", "这是一个没有学习过的中文句子", "これは学習されていない日本語の文です"]
    rows = docs.unionByName(spark.createDataFrame([(10_000_000 + i, t, None) for i, t in enumerate(odd)], "doc_id long, text string, lang string"))
    slips = spark.createDataFrame([(20_000_000 + i, t, None) for i, t in enumerate(["Thes iniblmb for.", "The xq of.", "De la ciónj."])], "doc_id long, text string, lang string")
    kept = {r["doc_id"] for r in language.keep_identified(rows.unionByName(slips)).collect()}
    assert {d for d in kept if d >= 20_000_000} == {20_000_000, 20_000_001, 20_000_002}  # short texts with a slip
    kept -= {20_000_000, 20_000_001, 20_000_002}
    assert max(kept) < 10_000_000
    assert kept == {r["doc_id"] for r in docs.collect() if any(c.isalpha() for c in r["text"])}


def test_dirty_labels_are_bounded_and_reruns_agree(spark, monkeypatch):
    rows = [(i, f"text number {i} of words", f"l{i % 30:02d}") for i in range(300)] + [(7, "a hot row", "l07")] * 200
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    monkeypatch.setattr(language, "MAX_LANGUAGES", 3)
    a, b = (language.train(d, sample=4) for d in (docs, docs.repartition(6)))
    assert a.languages == b.languages and 1 <= len(a.languages) <= 3
