"""The corpus pipeline: each stage against a plain version over its own input; the contract's shape."""

import re
import zlib

import numpy as np
import public_tokenizers
from llm_fixtures import SMALL_SF, edge_docs, edge_rows, no_docs  # noqa: F401
from test_mixing import stepwise
from test_neardup import classes
from tokenizers import Tokenizer as Library

import corpus_pipeline
from ticketlens.llm import queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _mixed_as_near_as_can_be(given, mixed):
    """Per source: whole copies and the subset sum nearest to the rest of its target, by all sums of its documents."""
    words = [(r["doc_id"], r["source"], len(WORD.findall(r["text"]))) for r in given]
    sources = sorted({s for _, s, _ in words}, key=lambda s: (s is None, s or ""))
    sizes = [sum(n for _, t, n in words if t == s) for s in sources]
    for source, size, target in zip(sources, sizes, stepwise(sizes)):
        own = [n for _, s, n in words if s == source]
        whole = min(int(target // size), 3) if size else 0
        budget = round(target - whole * size) if whole < 3 else 0
        reach = 1
        for n in own:
            reach |= reach << n
        best = min((abs(s - budget), s) for s in range(size + 1) if reach >> s & 1)
        taken = sum(len(WORD.findall(r["text"])) for r in mixed if r["source"] == source)
        assert taken - whole * size == best[1], (source, taken, target)


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SMALL_SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language", "near-duplicates", "decontamination", "mix", "tokens"]
    given, outputs = docs, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        given = stage(spark, given, SMALL_SF).cache()
        assert given.columns == COLUMNS
        outputs.append(given.collect())
    language, single, clean, mixed = outputs
    assert {r["doc_id"] for r in language} == {r["doc_id"] for r in docs.collect() if any(c.isalpha() for c in r["text"])}
    group = classes({r["doc_id"]: r["text"] for r in language})
    assert sorted(r["doc_id"] for r in single) == sorted(set(group.values()))
    items = [r["text"].lower().split() for r in spark.read.parquet(f"{SMALL_SF}/benchmark.parquet").collect()]

    def holds(text):
        words = f" {' '.join(text.lower().split())} "
        return any(f" {' '.join(i[1:-1])} " in words for i in items)

    assert {r["doc_id"] for r in single} - {r["doc_id"] for r in clean} == {r["doc_id"] for r in single if holds(r["text"])}
    assert {tuple(r) for r in mixed} <= {tuple(r) for r in clean}
    _mixed_as_near_as_can_be(clean, mixed)
    result = sorted(map(tuple, corpus_pipeline.STAGES[-1][1](spark, given, SMALL_SF).collect()), key=lambda r: r[1])
    library = Library.from_file(public_tokenizers.path("word_bpe_49k.json"))
    at = 0
    for row, doc in zip(result, sorted(mixed, key=lambda r: r["doc_id"]), strict=True):
        ids = np.array([*library.encode(doc["text"], add_special_tokens=False).ids, 1], dtype="<u4")
        assert row == (doc["doc_id"], at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_run_over_small_tables(spark, tmp_path, edge_docs, no_docs):
    spark.createDataFrame([(1, "one two three four")], "item_id long, text string").write.parquet(f"{tmp_path}/a/benchmark.parquet")
    edge_docs.write.parquet(f"{tmp_path}/a/documents.parquet")
    rows = corpus_pipeline.run(spark, f"{tmp_path}/a").collect()
    assert rows and not {2, 4, 5, 6, 12} & {r["doc_id"] for r in rows}
    no_docs.write.parquet(f"{tmp_path}/b/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/b/benchmark.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/b").collect() == []


def test_queries_return_the_contracts_columns(spark):
    import duckdb

    want = {
        "op2_token_codes": {"doc_id", "start", "n_tokens", "ids_crc32"},
        "op3_ppm_language": {"doc_id", "held_out", "lang_pred", "score"},
        "op4_budget_mix": {"doc_id", "size", "source_size", "target", "taken"},
        "op5_bilstm_crf": {"doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"},
        "op6_tiled_topk": {"query_id", "rank", "vec_id", "score"},
        "op8_page_difference": {"page_id", "url", "text", "n_chars"},
    }
    for n in range(1, 14):
        assert sum(q.startswith(f"op{n}_") for q in queries.QUERIES) == 1
    for name in ("op4_budget_mix", "op8_page_difference", "op6_tiled_topk"):
        df = queries.QUERIES[name](spark, SMALL_SF)
        assert want[name] <= set(df.columns)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SMALL_SF}/embeddings.parquet')")
    rows = con.execute(queries.ORACLE["op6_tiled_topk"]).fetchall()
    assert sorted(rows) == sorted(map(tuple, queries.QUERIES["op6_tiled_topk"](spark, SMALL_SF).collect()))
