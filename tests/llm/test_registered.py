"""Registered queries over small tables, and the pipeline stage by stage."""

import os

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from fleetlens import llm
from fleetlens.llm.tokens import vocabulary

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data here")


@pytest.mark.parametrize("name", sorted(llm.ORACLES))
def test_sql_agrees(spark, name):
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{DATA}/{f}'")
    df = llm.QUERIES[name](spark, DATA)
    names = sorted(df.columns)
    got = sorted(repr(tuple(r[c] for c in names)) for r in df.collect())
    cursor = con.execute(llm.ORACLES[name])
    at = [d[0] for d in cursor.description]
    assert got == sorted(repr(tuple(r[at.index(c)] for c in names)) for r in cursor.fetchall())


def test_pipeline(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    counts = [docs.count()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = corpus_pipeline.materialize(stage(spark, docs, DATA), f"test-{k}")
        counts.append(out.count())
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns, name
        docs = out
    assert counts[1] < counts[0] and counts[2] < counts[1] and counts[-1] > 0
    assert len({(r.sequence_id, r.offset) for r in docs.select("sequence_id", "offset").collect()}) == counts[-1]


def test_packed_sequences_hold_their_ids(spark):
    texts = {1: "one two <|endoftext|> three", 2: "four " * 1500, 3: ""}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {}
    for r in corpus_pipeline.pack_sequences(spark, docs, DATA).collect():
        got.setdefault(r.doc_id, []).append((r.start, np.frombuffer(r.ids, "<u4").tolist()))
    plain = Tokenizer.from_file(vocabulary())
    assert {d: sum((ids for _, ids in sorted(rs)), []) for d, rs in got.items()} == {d: [*plain.encode(t, add_special_tokens=False).ids, 2] for d, t in texts.items()}


CONTRACTS = {
    "op2_quality_classifier": "doc_id bigint, held_out boolean, score double, predicted int",
    "op3_media_columns": "doc_id bigint, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string",
    "op4_suffix_array_dedup": "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
    "op5_token_store": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    "op6_mixing": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op7_embedding_near_dedup": "vec_id bigint, n_links bigint, component_id bigint, kept boolean",
    "op8_best_fit_packing": "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    "op10_minhash_near_dedup": "doc_id bigint, class_id bigint",
    "op11_document_fingerprint": "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
}


@pytest.fixture(scope="module")
def awkward(spark, tmp_path_factory):
    """Tables with nulls, repeats, empty and long texts and further columns whose names clash."""
    folder = str(tmp_path_factory.mktemp("awkward"))
    long = " ".join(f"w{i * 7919 % 997}" for i in range(120_000))
    rows = [(1, "a b c d e f", "s"), (1, "a b c d e f", "s"), (2, None, None), (3, "", "s"), (4, long, "t"), (5, "x " + long[:900_000], "t"), (6, "é" * 300, None), (7, "one two three", "s"), (8, "\x00 \t\n", "t")]
    extra = "'x' AS node, 1 AS sig, 2 AS n, 3 AS length, 4 AS piece, 5 AS ids, 6 AS target, 7 AS taken, 8 AS size, 9 AS score, 10 AS row, 11 AS part, 12 AS hash, 13 AS class_id, 14 AS copies, 15 AS spans, 16 AS payload"
    spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "'en' AS lang", "cast(length(text) AS long) AS n_chars", extra.split(", ")[0], *extra.split(", ")[1:]).coalesce(1).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (2, 0, 0), (4, 1, None), (5, None, 1), (None, 1, 0), (7, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, [1.0, 2.0], 1), (2, [2.0, 4.0], 1), (3, None, 1), (4, [0.0], 1), (5, [3.0], 1)], "vec_id long, embedding array<float>, id int").write.parquet(f"{folder}/embeddings.parquet")
    spark.createDataFrame([(1, "a b"), (None, None), (2, "zzz")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_audit_and_search_of_awkward_tables(spark, awkward):
    audit = llm.QUERIES["op12_filter_audit"](spark, awkward)
    assert dict(audit.dtypes) == {"part": "string", "filter_order": "string", "step": "int"} | dict.fromkeys(("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"), "bigint")
    assert audit.where("filter_order = 'EDCBA' AND step = 1").selectExpr("sum(kept + removed)").first()[0] == 9
    found = llm.QUERIES["op13_lexical_search"](spark, awkward)
    assert dict(found.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}
    assert [r.doc_id for r in found.orderBy("rank").collect()] == [1, 1]


@pytest.mark.parametrize("name", CONTRACTS)
def test_contracts_hold_for_awkward_tables(spark, awkward, name):
    df = llm.QUERIES[name](spark, awkward)
    types = dict(df.dtypes)
    assert {c.split()[0]: types.get(c.split()[0]) for c in CONTRACTS[name].split(", ")} == dict(c.split() for c in CONTRACTS[name].split(", "))
    rows = df.collect()
    key = "vec_id" if "vec_id" in types else "doc_id"
    ids = sorted(r[key] for r in rows if "piece" not in types or r["piece"] == 0)
    assert ids == ([1, 2, 3, 4, 5] if key == "vec_id" else [1, 1, 2, 3, 4, 5, 6, 7, 8])


def test_pipeline_of_awkward_tables(spark, awkward):
    docs = spark.read.parquet(f"{awkward}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        if name != "quality classifier":  # four labels decide nothing here
            out = corpus_pipeline.materialize(stage(spark, docs, awkward), f"awkward-{k}")
            empty = stage(spark, docs.limit(0), awkward)
            assert empty.count() == 0 and (name == "best-fit packing" or out.columns == docs.columns), name
            docs = out
    assert docs.count() > 0


def test_stages_pass_columns_of_any_name(spark):
    names = ["__key", "__node", "__size", "__removed", "__kept", "x.y", "a`b c", "passing", "kept", "target", "size", "node"]
    rows = [(k, f"word{k} " * 9 + f"tail{k}", "s" if k % 2 else None, *(f"{n}{k}" for n in names)) for k in range(12)] + [(None, None, "s", *names), (None, "w " * 3, None, *names), (3, "other text", "s", *names)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join("`" + n.replace("`", "``") + "` string" for n in names))
    for _, stage in corpus_pipeline.STAGES[1:4]:
        out = stage(spark, docs, DATA)
        assert out.columns == docs.columns
        kept = {tuple(r) for r in out.select(*("`" + c.replace("`", "``") + "`" for c in docs.columns if c != "text")).collect()}
        assert kept and kept <= {(r[0], *r[2:]) for r in rows}


def test_rows_without_id_stand_in_many_buckets(spark):
    df = spark.range(4000).selectExpr("cast(null AS bigint) AS doc_id", "'s' AS source", "id % 7 + 1 AS size", "id AS salt")
    assert df.select(llm.mixing.key_of(df.doc_id, salt=df.salt)).distinct().count() == 4000
    taken = llm.mixing.mix(df, salt="salt").selectExpr("sum(taken)", "first(target)").first()
    assert taken[0] == taken[1] == 4000 // 7 * 28 + sum(range(1, 4000 % 7 + 1))


def test_url_verdicts_beside_columns_of_their_names(spark):
    captures = spark.createDataFrame([("http://a.b/", 1, "p", "q", "r")], "url string, fetched int, verdict string, verdict_before string, `x.y` string")
    entries = spark.createDataFrame([("host", "a.b", "block", 0)], "kind string, key string, verdict string, listed int")
    row = llm.urls.judge(captures, entries).first()
    assert row.asDict() == {"url": "http://a.b/", "fetched": 1, "verdict_before_before": "p", "verdict_before": "q", "x.y": "r", "verdict": "block", "rule_kind": "host", "rule_key": "a.b", "listed": 0}


def test_queries_are_whole():
    assert sorted(int(n[2:].split("_")[0]) for n in llm.QUERIES) == list(range(1, 14))
