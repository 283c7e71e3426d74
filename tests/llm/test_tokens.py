"""Tokens, store, packing, mixing, media and the classifier."""

import random
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fleetlens.llm import licenses, media, mixing, packing, quality, token_store, tokens, urls
from fleetlens.llm._spark import fresh_path
from fleetlens.llm._vec import blocks
from fleetlens.llm.tokens import encoder, vocabulary

ODD = list("abcXYZ éßñ×÷012'’s.,!\n\t   　 ​日本語ł🙂|%$\r\x1c\x85") + [" the", " a", "'s", "'ll", "\n\n", "  ", "<|endoftext|>"]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from(ODD), max_size=50).map("".join), max_size=8))
def test_ids_are_the_librarys(texts):
    plain, enc = Tokenizer.from_file(vocabulary()), encoder(vocabulary())
    for b in blocks(pa.array(texts, pa.string()), 100):
        ids, first = enc.encode(b)
        for i in range(len(first) - 1):
            assert plain.encode(texts[b.first + i], add_special_tokens=False).ids == ids[first[i] : first[i + 1]].tolist()


MARKED = ["<|endoftext|>", "<|endoftext|>", "<|endof", "text|>", "<|", "|>", "<", "a", "é", "'s", " ", "\n", "  ", ".", "7", "\t", "日"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from(MARKED), max_size=12).map("".join), max_size=8))
def test_added_tokens_are_the_unmodified_librarys(texts):
    plain, enc = Tokenizer.from_file(vocabulary()), encoder(vocabulary())
    for b in blocks(pa.array(texts, pa.string()), 60):
        ids, first = enc.encode(b)
        for i in range(len(first) - 1):
            assert plain.encode(texts[b.first + i], add_special_tokens=False).ids == ids[first[i] : first[i + 1]].tolist()


def test_ids_of_an_added_token_by_name():
    texts = ["a <|endoftext|> b", "a <|endof", "text|> b"]
    ids, first = encoder(vocabulary()).encode(next(blocks(pa.array(texts, pa.string()))))
    assert ids[: first[1]].tolist() == [64, 220, 50256, 275] and 50256 not in ids[first[1] :]


def test_ids_of_real_texts_with_small_caches(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_SEGMENTS", 300)
    monkeypatch.setattr(tokens, "CACHE_SLOTS", 512)
    monkeypatch.setattr(tokens, "CACHE_BYTES", 500)
    texts = pq.read_table("/root/testdata/sf0.001/documents.parquet", columns=["text"])["text"].combine_chunks()
    plain, enc = Tokenizer.from_file(vocabulary()), tokens.Encoder(vocabulary())
    for size in (3_000, 1 << 20):
        for b in blocks(texts, size):
            ids, first = enc.encode(b)
            for i in range(len(first) - 1):
                assert plain.encode(texts[b.first + i].as_py(), add_special_tokens=False).ids == ids[first[i] : first[i + 1]].tolist()


def test_segments_differ_by_length_and_zero_bytes():
    texts = ["a", "a\0", "a\0\0", "\0a", "aaaaaaaa", "aaaaaaaa\0", "aaaaaaaaa", "b" * 16, "b" * 17, "\0" * 16, "\0" * 8]
    plain, enc = Tokenizer.from_file(vocabulary()), tokens.Encoder(vocabulary())
    for _ in range(2):
        ids, first = enc.encode(next(blocks(pa.array(texts, pa.string()))))
        assert [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:])] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def expected_ids(texts):
    enc = Tokenizer.from_file(vocabulary())
    return [[*enc.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(8)
    words = [rng.choice(["the", "of", "thing", "é", "x.", "\n"]) + str(rng.randrange(50)) for _ in range(400)]
    passage = " ".join(rng.choices(words, k=2500))
    return [" ".join(rng.choices(words, k=rng.randrange(0, 900))) for _ in range(30)] + [passage, passage + " end", "start " + passage, None, "", "", "same", "same"]


def test_store_round_trip(spark, texts):
    df = spark.createDataFrame([(len(texts) - i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, hash string")
    path = fresh_path(spark, "store")
    token_store.write(df, path)
    want, at = {}, 0
    for doc_id, ids in sorted(zip((len(texts) - i for i in range(len(texts))), expected_ids(texts))):
        want[doc_id] = (at, ids)
        at += len(ids)
    got = {r.doc_id: r for r in token_store.read(spark, path).collect()}
    assert {d: (r.start, np.frombuffer(r.ids, "<u4").tolist()) for d, r in got.items()} == want
    crc = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_store.digests(spark, path).collect()}
    assert crc == {d: (s, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for d, (s, ids) in want.items()}
    assert token_store.damaged(spark, path).count() == 0
    c = spark.read.parquet(f"{path}/chunks").where("body is not null")
    assert c.count() == c.select("hash").distinct().count() < sum(len(ids) for _, ids in want.values()) / token_store.LEAST_IDS + len(texts)


def _swap_chunks(r):
    return r.withColumn("chunks", F.reverse("chunks"))


DAMAGE = {
    "a lost recipe": ("recipes", lambda r: r.where("doc_id <> 1"), "manifest"),
    "chunks in another order": ("recipes", _swap_chunks, "root"),
    "another root": ("recipes", lambda r: r.withColumn("root", F.sha2(F.lit(b"x"), 256)), "root|manifest"),
    "a changed count": ("recipes", lambda r: r.withColumn("n_tokens", F.col("n_tokens") + 1), "root|manifest"),
    "a changed manifest": ("manifest", lambda m: m.withColumn("tokens", F.col("tokens") + 1), "manifest"),
    "a lost manifest": ("manifest", lambda m: m.where("false"), "manifest"),
    "another single root": ("root", lambda m: m.withColumn("root", F.lit("0")), "manifest"),
    "a missing body": ("chunks", lambda c: c.where("not array_contains(transform(uses, u -> u.doc_id), 1)"), "no body"),
    "a body twice": ("chunks", lambda c: c.unionByName(c), "not complete"),
}


@pytest.mark.parametrize("what", DAMAGE)
def test_reading_a_damaged_store_fails(spark, what):
    name, change, message = DAMAGE[what]
    path = fresh_path(spark, "store")
    words = " ".join(f"w{i * 7919 % 3001}" for i in range(1500))
    token_store.write(spark.createDataFrame([(1, words), (2, "d")], "doc_id long, text string"), path)
    change(spark.read.parquet(f"{path}/{name}")).write.parquet(f"{path}/changed")
    spark.read.parquet(f"{path}/changed").write.mode("overwrite").parquet(f"{path}/{name}")
    for way in (token_store.read, token_store.digests):
        with pytest.raises(Exception, match=message):
            way(spark, path).collect()


def test_bodies_are_checked_against_their_hashes():
    with pytest.raises(ValueError, match="hash"):
        token_store._body(b"0" * 16, 1, __import__("zstandard").ZstdCompressor().compress(b"\1\0"))


def test_a_frequent_chunk_is_stored_once(spark):
    path = fresh_path(spark, "store")
    token_store.write(spark.createDataFrame([(i, "" if i % 3 else None) for i in range(200)] + [(500, "x")], "doc_id long, text string"), path)
    c = spark.read.parquet(f"{path}/chunks")
    assert c.where("body is not null").count() == 2 and c.selectExpr("sum(size(uses))").first()[0] == 201
    assert token_store.digests(spark, path).count() == 201


def test_crcs_join():
    rng = np.random.default_rng(0)
    parts = [rng.integers(0, 50_000, n).astype("<u4") for n in (5, 1, 300, 7)]
    crc, n = np.array([zlib.crc32(p.tobytes()) for p in parts], np.uint32), np.array([len(p) for p in parts])
    got = token_store.join_crcs(crc, n, np.array([0, 3, 3, 4]))
    assert got.tolist() == [zlib.crc32(np.concatenate(parts[:3]).tobytes()), 0, zlib.crc32(parts[3].tobytes())]


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=25))
def test_plans_place_every_length(counts):
    plan = packing.plan(counts, 64)
    placed = Counter()
    for pattern, n in plan:
        assert n > 0 and sum(pattern) <= 64 and sum(3 * x > 64 for x in pattern) <= 2
        for x in pattern:
            placed[x] += n
    assert placed == Counter(counts)
    bins, total = sum(n for _, n in plan), sum(k * v for k, v in counts.items())
    assert bins <= 1.5 * max(-(-total // 64), sum(v for k, v in counts.items() if k > 32)) + 1


def test_packing(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").union(spark.createDataFrame([(0, texts[0])], "doc_id long, text string"))
    got = packing.pack(df).collect()
    ids = dict(enumerate(expected_ids(texts)))
    by_doc, by_sequence = {}, {}
    for r in got:
        assert np.frombuffer(r.ids, "<u4").tolist() == ids[r.doc_id][r.start : r.start + r.length] and r.ids_crc32 == zlib.crc32(r.ids)
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for d, rs in by_doc.items():
        assert sum(r.length for r in rs) == len(ids[d]) * (2 if d == 0 else 1) and all(r.length == 1024 for r in rs if r.piece)
    for places in by_sequence.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= 1024
    assert packing.pack(df.where("doc_id < 0")).count() == 0


def test_mixing_fills_targets(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice(["a", "b", "b", "b", "b", None, "tiny"] if i % 9 else ["tiny"]), rng.randrange(0, 60)) for i in range(800)]
    rows += [(None, "a", 5), (None, "a", 5), (3, "z", 0)]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long")
    got = mixing.mix(df).collect()
    total = sum(r[2] for r in rows)
    by = {}
    for r in got:
        by.setdefault(r.source, []).append(r)
        assert 0 <= r.taken <= 3 * r.size
    assert abs(sum(rs[0].target for rs in by.values()) - total) < 1e-6 * total and len(got) == len(rows)
    for rs in by.values():
        assert abs(sum(r.taken for r in rs) - rs[0].target) <= 0.5 and rs[0].target <= 3 * rs[0].source_size
    again = {(r.doc_id, r.source, r.size, r.taken) for r in mixing.mix(df.repartition(7)).collect()}
    assert again == {(r.doc_id, r.source, r.size, r.taken) for r in got}
    assert mixing.mix(df.where("size < 0")).count() == 0
    with pytest.raises(ValueError, match="taken"):
        mixing.mix(df.selectExpr("*", "1 AS taken"))


def test_mixing_passes_other_columns_through(spark):
    rows = [(1, "a b c", "s", 100 + i, 200 + i, 300 + i) for i in range(4)] + [(1, "x y z", "s", 7, 7, 7), (2, None, None, 1, 1, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, target int, taken int, source_size int")
    out = mixing.sample(df)
    assert out.columns == df.columns and {tuple(r) for r in out.collect()} <= set(rows)
    assert Counter(map(tuple, out.collect())) == Counter(map(tuple, mixing.sample(df.repartition(3)).collect()))


def test_mixed_rows_repeat(spark):
    df = spark.createDataFrame([(i, "one two three", "s" if i % 4 else "t", 13, "x") for i in range(40)] + [(99, None, None, 0, None)], "doc_id long, text string, source string, n_chars long, taken string")
    out = mixing.sample(df)
    assert out.columns == df.columns and max(Counter(r.doc_id for r in out.collect()).values()) <= 3


def test_media_round_trip_and_damage(spark, tmp_path):
    docs = ["", None, "x", "é" * 40, "y" * 5000, "same", "same"]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    path = f"file://{tmp_path}/archives"
    media.write(df.repartition(2), path)
    got = {r.doc_id: r for r in media.described(media.read(spark, path)).collect()}
    for i, t in enumerate(docs):
        raw = (t or "").encode()
        full = media.padded(raw)
        r = got[i]
        assert len(full) % 64 == 0 and full and (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32, r.error) == (len(raw), len(full), sha256(full).hexdigest(), zlib.crc32(full[-64:]), None)
    assert got[5].feature == got[6].feature and got[5].media_sha256 == got[6].media_sha256 != got[4].media_sha256
    member = next(r for r in media.read(spark, path).collect() if r.doc_id == 4)
    place = tmp_path / "archives" / member.archive
    data = bytearray(place.read_bytes())
    data[data.index(bytes(member.media)) + 60] ^= 255
    place.write_bytes(data)
    again = {r.doc_id: r for r in media.described(media.read(spark, path)).collect()}
    assert "damaged member" in again[4].error and again[4].payload_bytes is None and all(again[i].error is None for i in got if i != 4)
    media.write(df.where("doc_id < 0"), f"file://{tmp_path}/none")
    assert media.read(spark, f"file://{tmp_path}/none").count() == 0


def test_classifier_learns_and_keeps_out_labels(spark):
    rng = random.Random(6)
    clean = lambda: " ".join(rng.choice("alpha beta gamma delta eps zeta".split()) + rng.choice("abcdef") for _ in range(60))
    junk = lambda: " ".join(rng.choice("alpha beta gamma delta".split()) + rng.choice(["!!", "###"]) for _ in range(60))
    rows = [(i, clean() if i % 5 else junk(), int(i % 5 > 0), "n") for i in range(400)] + [(1000, None, None, None), (1001, "", None, None), (None, clean(), 1, None), (1002, "x" * 200_000, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int, score string")
    labels = df.select("doc_id", "quality")
    kept = {r.doc_id for r in quality.accepted(df, labels).collect()}
    wrong = [i for i in range(400) if (i in kept) != (i % 5 > 0)]
    assert len(wrong) <= 4
    out = quality.score(df, quality._training(df, labels), column="p").collect()
    assert len(out) == len(rows) and all(0 <= r.p <= 1 for r in out)
    none = quality._training(df, labels.where("doc_id < 0"))
    assert {r.p > 0.3 for r in quality.score(df, none, column="p").collect()} == {True}
    assert quality.accepted(df.where("doc_id < -1"), labels).count() == 0


def brute_dice(part, template):
    a, b = set(licenses.bigrams_of(part)), set(licenses.bigrams_of(template))
    return 2 * len(a & b) / (len(a) + len(b)) if a and b else 0.0


def test_licenses(spark):
    mit = "Released under the MIT License."
    grant = next(t for _, n, t in licenses.TEMPLATES if n == "mit-grant")
    docs = [f"words\n{mit}\nmore words", grant.replace(", free of charge,", "").replace(" to the", "\nto the"), "licensed to thrill", None, "", mit, f"a\n\n{mit}\n{mit}", "under cc by 4 0 of", "x " * 3000 + "license"]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(docs)] + [(0, docs[0], "clash")], "doc_id long, text string, license string")
    got = licenses.scan(df).collect()
    want = Counter()
    for i, t in [*enumerate(docs), (0, docs[0])]:
        paragraphs = __import__("re").split(r"\n[ \t\r]*\n", t or "")
        units = [("line", k, x) for k, x in enumerate((t or "").split("\n"))] + [("paragraph", k, x) for k, x in enumerate(paragraphs) if "\n" in x] + ([("text", 0, t)] if len(paragraphs) > 1 else [])
        for unit, k, part in units:
            best = max(((brute_dice(part, x), n) for _, n, x in licenses.TEMPLATES), key=lambda v: (v[0], [-ord(c) for c in v[1]]))
            if best[0] >= licenses.DICE:
                want[(i, unit, k, best[1], round(best[0], 9))] += 1
    assert Counter((r.doc_id, r.unit, r.position, r.template, round(r.dice, 9)) for r in got) == want and len(want) >= 5
    assert licenses.scan(df.where("doc_id < 0")).count() == 0


def test_urls(spark):
    pages = [(1, "http://a.b.example.com/x/y/z?q", "2024-01-10"), (2, "https://u@A.b.example.com:80/", "2024-01-10"), (3, "http://b.example.com", "2024-01-01"), (4, "not a url", "2024-01-10"), (5, None, "2024-01-10"), (6, "http://a.b.example.com/x/", None), (1, "http://a.b.example.com/x/y/z?q", "2024-03-10")]
    entries = [("domain", "example.com", "block", "2024-01-05"), ("host", "a.b.example.com", "allow", "2024-01-02"), ("host", "a.b.example.com", "none", "2024-02-01"), ("path", "a.b.example.com/x/", "block", "2024-01-10"), ("path", "a.b.example.com/x/", "none", "2024-03-01"), ("host", None, "block", "2024-01-01")]
    p = spark.createDataFrame(pages, "page_id long, url string, day string").selectExpr("*", "cast(day AS date) AS fetched", "1 AS verdict_")
    e = spark.createDataFrame(entries, "kind string, key string, verdict string, listed string").selectExpr("kind", "key", "verdict", "cast(listed AS date) AS listed")
    got = sorted((r.page_id, r.verdict, r.rule_kind or "") for r in urls.judge(p, e).collect())
    assert got == [(1, "block", "domain"), (1, "block", "path"), (2, "allow", "host"), (3, "none", ""), (4, "none", ""), (5, "none", ""), (6, "none", "")]
    clash = urls.judge(p.selectExpr("page_id", "url", "fetched", "'mine' AS verdict", "7 AS at", "8 AS k", "9 AS key", "10 AS listed"), e)
    assert clash.columns == ["page_id", "url", "fetched", "verdict_before", "at", "k", "key", "listed_before", "verdict", "rule_kind", "rule_key", "listed"]
    assert sorted((r.page_id, r.verdict, r.rule_kind or "") for r in clash.collect()) == got
    assert {(r.verdict_before, r["at"], r.k, r.key, r.listed_before) for r in clash.collect()} == {("mine", 7, 8, 9, 10)}
    assert urls.judge(p.where("page_id < 0"), e).count() == 0 and urls.judge(p, e.where("key = ''")).where("verdict <> 'none'").count() == 0


def test_classifier_solves_the_dual(monkeypatch):
    """The fit against a plain dense one: ratios by counting, and the conditions that an optimum of the dual meets."""
    monkeypatch.setattr(quality, "EPOCHS", 3000)
    monkeypatch.setattr(quality, "TOLERANCE", 1e-7)
    rng = np.random.default_rng(5)
    label = (rng.random(120) < 0.4).astype(int)
    rows = [np.unique(np.concatenate([rng.integers(0, 40, 12), 40 + 20 * y + rng.integers(0, 20, 3)])) for y in label]
    model = quality.fit(rows, label)
    dense = np.zeros((len(rows), 100))
    for i, r in enumerate(rows):
        dense[i, r] = 1
    counts = [dense[label == c].sum(0) + quality.ALPHA for c in (0, 1)]
    ratio = np.log((counts[1] / ((label == 1).sum() + 2 * quality.ALPHA)) / (counts[0] / ((label == 0).sum() + 2 * quality.ALPHA)))
    ratio[counts[0] + counts[1] <= 2 * quality.ALPHA + 1] = 0
    assert np.allclose(model["ratio"][:100], ratio, atol=1e-5)
    x = dense * ratio
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    used = np.arange(len(rows)) % 5 != 4
    x, y, share = x[used], np.where(label[used] == 1, 1.0, -1.0), label.mean()
    cost = quality.COST * np.where(y > 0, 0.5 / share, 0.5 / (1 - share))
    w = np.divide(model["weight"][:100], ratio, out=np.zeros(100), where=ratio != 0)
    margin = y * (x @ w + model["bias"])
    primal = 0.5 * (w @ w + model["bias"] ** 2) + (cost * np.maximum(0, 1 - margin)).sum()
    # projected gradient on the dense dual, from nothing
    z = np.column_stack([x, np.ones(len(x))]) * y[:, None]
    q, a = z @ z.T, np.zeros(len(x))
    for _ in range(60_000):
        a = np.clip(a - (q @ a - 1) / np.linalg.norm(q, 2), 0, cost)
    dual = a.sum() - 0.5 * a @ q @ a
    assert dual <= primal * (1 + 1e-6) and primal - dual < 2e-3 * primal


def test_whole_license_files(spark):
    full = {n: t for _, n, t in licenses.TEMPLATES}
    texts = [
        "MIT License\n\nCopyright (c) 2024 A B\n\n" + full["mit-text"].replace("conditions: ", "conditions:\n\n").replace("Software. THE", "Software.\n\nTHE"),
        "BSD\n\n" + full["bsd3-text"], full["zlib-text"].replace(". ", ".\n"), "x_Released_under_the_MIT_License_", "__Released_under_the_MIT_License__", "sublicense relicensed unlicensed",
    ]
    got = {(r.doc_id, r.unit, r.template) for r in licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert {(0, "text", "mit-text"), (1, "text", "bsd3-text"), (1, "line", "bsd3-text"), (2, "paragraph", "zlib-text")} <= got
    assert (0, "line", "mit-warranty") in got and (0, "line", "mit-grant") in got and (4, "line", "mit-line") in got
    assert not [g for g in got if g[0] == 5]


def test_hints_are_lossless():
    import re

    any_hint = [re.compile(licenses.any_of(licenses.hints(licenses.bigrams_of(t))).replace(r"[^\p{L}\p{N}]", r"[\W_]")) for _, _, t in licenses.TEMPLATES]
    rng = np.random.default_rng(5)
    for hint, (_, _, t) in zip(any_hint, licenses.TEMPLATES):
        words = re.sub(r"[\W_]+", " ", t.lower()).split()
        for _ in range(40):
            kept = [w for w in words if rng.random() < 0.85]
            a, b = set(licenses.bigrams_of(" ".join(kept))), set(licenses.bigrams_of(t))
            if a and 2 * len(a & b) / (len(a) + len(b)) >= licenses.DICE:
                assert hint.search("_".join(kept))
