"""Site snapshots: the sealed file as a source, and each kind of damage as a row."""

import hashlib
import json
import sqlite3

import pytest
from pyspark.sql import functions as F

from fleetlens.operators import snapshots
from fleetlens.sources import snapshot

ROWS = "id long, source_product_id string, public_id string, availability string, fields_json string, is_pdf long, doc_path string, doc_bytes long, doc_sha256 string"
PHOTOS = "public_id string, announcement_public_id string, photo_path string, pdf_offset long, photo_bytes long, photo_sha256 string, width long, height long"


@pytest.fixture
def site(tmp_path):
    root = tmp_path / "root"
    (root / "docs").mkdir(parents=True)
    pdf, jpg = b"%PDF-1.7 picture inside", b"JPEG alone"
    (root / "docs" / "a.pdf").write_bytes(pdf)
    (root / "docs" / "b.jpg").write_bytes(jpg)
    path = tmp_path / "site.sqlite"
    sha = lambda b: hashlib.sha256(b).hexdigest()
    with sqlite3.connect(path) as con:
        con.execute("CREATE TABLE announcement_flat (id INTEGER PRIMARY KEY, source_product_id, public_id, availability, fields_json, is_pdf, doc_path, doc_bytes, doc_sha256)")
        con.execute("INSERT INTO announcement_flat VALUES (1, 'P1', 'abcdef123456', 'published', ?, 1, 'docs/a.pdf', ?, ?)", (json.dumps({"f": "电"}), len(pdf), sha(pdf)))
        con.execute("INSERT INTO announcement_flat VALUES (7, 'tracking:E1', '123456abcdef', 'pending_source', NULL, 0, NULL, NULL, NULL)")
        con.execute("CREATE TABLE announcement_photos (public_id, announcement_public_id, photo_path, pdf_offset, photo_bytes, photo_sha256, width, height)")
        con.execute("INSERT INTO announcement_photos VALUES ('F1', 'abcdef123456', 'docs/a.pdf', 9, 7, ?, 2, 2)", (sha(b"picture"),))
        con.execute("INSERT INTO announcement_photos VALUES ('F2', 'abcdef123456', 'docs/b.jpg', NULL, ?, ?, 2, 2)", (len(jpg), sha(jpg)))
        con.execute("CREATE TABLE model_series (id, name)")
        con.execute("INSERT INTO model_series VALUES (1, 'x')")
        con.execute("CREATE TABLE search_fts (public_id)")
        con.executemany("INSERT INTO search_fts VALUES (?)", [("abcdef123456",), ("123456abcdef",)])
        con.execute("CREATE TABLE meta (key, value)")
        con.executemany("INSERT INTO meta VALUES (?, ?)", {"schema_version": "3", "collection_scope": "automotive_complete_v1", "source_rows": "2", "series_count": "1", "published_rows": "1"}.items())
    return path, root


def found(spark, site):
    path, root = site
    t = lambda name, schema=None: snapshot.read(spark, str(path), name, schema, parts=3)
    checks = snapshot.read(spark, str(path), snapshot.CHECKS)
    df = snapshots.violations(t("meta"), t("announcement_flat", ROWS), t("announcement_photos", PHOTOS), t("model_series"), t("search_fts"), snapshots.assets(spark, str(root)), checks)
    return sorted((r.kind, r.subject) for r in df.collect())


def test_a_sound_snapshot_has_no_violation(spark, site):
    assert found(spark, site) == []


DAMAGE = {
    "version": ("UPDATE meta SET value = '2' WHERE key = 'schema_version'", {("schema_version", "meta")}),
    "scope": ("DELETE FROM meta WHERE key = 'collection_scope'", {("collection_scope", "meta")}),
    "wrong count": ("UPDATE meta SET value = '999' WHERE key = 'source_rows'", {("source_rows", "meta")}),
    "series count": ("DELETE FROM model_series", {("series_count", "meta")}),
    "index": ("DELETE FROM search_fts WHERE rowid = 1", {("search_rows", "meta")}),
    "published count": ("UPDATE meta SET value = 'x' WHERE key = 'published_rows'", {("published_rows", "meta")}),
    "traversal": ("UPDATE announcement_flat SET doc_path = '../outside.pdf' WHERE is_pdf = 1", {("document_path", "P1"), ("photo_document", "F1"), ("photo_document", "F1")}),
    "no id": ("UPDATE announcement_flat SET source_product_id = NULL WHERE id = 7", {("no_product_id", "")}),
    "repeated": ("UPDATE announcement_flat SET source_product_id = 'P1'", {("repeated_product", "P1")}),
    "public id": ("UPDATE announcement_flat SET public_id = 'ABC' WHERE id = 7", {("public_id_form", "tracking:E1")}),
    "availability": ("UPDATE announcement_flat SET availability = 'gone' WHERE id = 7", {("availability", "tracking:E1")}),
    "fields": ("UPDATE announcement_flat SET fields_json = '[1]' WHERE id = 7", {("fields_no_object", "tracking:E1")}),
    "flag": ("UPDATE announcement_flat SET is_pdf = 0 WHERE id = 1", {("document_flag", "P1")}),
    "bytes": ("UPDATE announcement_flat SET doc_bytes = 5 WHERE id = 1", {("document_bytes", "P1")}),
    "digest": ("UPDATE announcement_flat SET doc_sha256 = 'x' WHERE id = 1", {("document_digest", "P1")}),
    "missing": ("UPDATE announcement_flat SET doc_path = 'docs/none.pdf' WHERE id = 1", {("document_missing", "P1"), ("photo_document", "F1")}),
    "photo owner": ("UPDATE announcement_photos SET announcement_public_id = 'x' WHERE public_id = 'F2'", {("photo_owner", "F2")}),
    "photo offset": ("UPDATE announcement_photos SET pdf_offset = -1 WHERE public_id = 'F1'", {("photo_offset", "F1"), ("photo_digest", "F1")}),
    "photo digest": ("UPDATE announcement_photos SET photo_sha256 = 'x'", {("photo_digest", "F1"), ("photo_digest", "F2")}),
    "photo size": ("UPDATE announcement_photos SET width = 0 WHERE public_id = 'F2'", {("photo_size", "F2")}),
    "photo bytes": ("UPDATE announcement_photos SET photo_bytes = 3 WHERE public_id = 'F2'", {("photo_bytes", "F2")}),
    "photo missing": ("UPDATE announcement_photos SET photo_path = 'docs/c.jpg' WHERE public_id = 'F2'", {("photo_missing", "F2")}),
}


#: Damages that don't touch each other, done together.
TOGETHER = (
    ("version", "wrong count", "series count", "no id", "photo owner", "bytes"), ("scope", "index", "published count", "public id", "photo size", "digest"), ("traversal", "availability", "photo bytes"),
    ("repeated", "flag", "photo missing"), ("fields", "missing"), ("photo offset",), ("photo digest",),
)


@pytest.mark.parametrize("kinds", TOGETHER)
def test_each_damage_is_a_row(spark, site, kinds):
    with sqlite3.connect(site[0]) as con:
        for kind in kinds:
            con.execute(DAMAGE[kind][0])
    assert set(found(spark, site)) == set().union(*(DAMAGE[kind][1] for kind in kinds))


def test_every_damage_is_done_once():
    assert sorted(k for ks in TOGETHER for k in ks) == sorted(DAMAGE)


def test_changed_asset_and_open_journal(spark, site):
    (site[1] / "docs" / "a.pdf").write_bytes(b"HTML-1.7 picture inside")
    assert found(spark, site) == [("document_digest", "P1"), ("document_kind", "P1")]
    site[0].with_name("site.sqlite-wal").write_bytes(b"pending")
    assert [(r.check, r.detail) for r in snapshot.read(spark, str(site[0]), snapshot.CHECKS).collect()] == [("unsealed", "-wal")]
    with pytest.raises(Exception, match="sealed"):
        snapshot.read(spark, str(site[0]), "meta").collect()


def test_filters_reach_the_file(spark, site):
    read = lambda push=True: snapshot.read(spark, str(site[0]), "announcement_flat", ROWS, parts=4, push=push)
    assert [r.id for r in read().where("availability = 'published' AND id < 5").collect()] == [1]
    assert [r.id for r in read().where("id IN (7, 9)").collect()] == [7] and read().where(F.col("doc_path").isNotNull()).count() == 1
    df = read(push=False)
    assert df.where("doc_path IS NULL").unionByName(df.where("doc_path IS NOT NULL")).count() == 2
    reader = snapshot.PushingReader({"path": str(site[0]), "table": "announcement_flat", "parts": "4", "push": "true"}, df.schema)
    left = list(reader.pushFilters([snapshot.EqualTo(("availability",), "published"), snapshot.GreaterThan(("source_product_id",), "A"), snapshot.In(("id",), (1, 2))]))
    assert len(left) == 3 and len(reader.where) == 2
    assert sum(len(list(reader.read(p))) for p in reader.partitions()) == 1
