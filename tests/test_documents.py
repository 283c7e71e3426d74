"""Documents that a resumed run may skip, and pages that the source failed to make."""

import hashlib

import pytest

from fleetlens.operators import documents as docs

FILES = "path string, length long, content binary"
DOCUMENTS = "product string, path string, is_pdf int, bytes long, sha256 string, error string, fields_json string, parse_error string"


def test_verified_documents_by_their_files(spark):
    pdf = b"%PDF-1.7 x"
    sha = hashlib.sha256(pdf).hexdigest()
    files = spark.createDataFrame([("a.pdf", len(pdf), pdf), ("b.pdf", len(pdf), pdf[:-1] + b"y"), ("c.pdf", 4, b"HTML")], FILES)
    n = len(pdf)
    rows = [
        ("ok", "a.pdf", 1, n, sha, None, '{"f": 1}', ""), ("parse", "a.pdf", 1, n, sha, "e", '{"f": 1}', "p"), ("error", "a.pdf", 1, n, sha, "e", '{"f": 1}', ""), ("empty", "a.pdf", 1, n, sha, "", "{}", None), ("absent", "a.pdf", 1, n, sha, "", None, None),
        ("list", "a.pdf", 1, n, sha, "", "[1]", ""), ("broken", "a.pdf", 1, n, sha, "", "{", ""), ("digest", "b.pdf", 1, n, sha, "", '{"f": 1}', ""), ("size", "a.pdf", 1, n + 1, sha, "", '{"f": 1}', ""), ("gone", "d.pdf", 1, n, sha, "", '{"f": 1}', ""),
        ("html", "c.pdf", 1, 4, hashlib.sha256(b"HTML").hexdigest(), "", '{"f": 1}', ""), ("no flag", "a.pdf", 0, n, sha, "", '{"f": 1}', ""), ("no digest", "a.pdf", 1, n, None, "", '{"f": 1}', ""),
    ]
    df = spark.createDataFrame(rows, DOCUMENTS)
    got = {r["product"]: (r.outcome, r.message.removeprefix(docs.NOT_PARSED)) for r in docs.verified(df, files).collect()}
    assert got == {
        "ok": ("skipped_existing", ""), "parse": ("parse_failed", "p"), "error": ("parse_failed", "e"), "empty": ("parse_failed", docs.NO_FIELDS), "absent": ("parse_failed", docs.NO_FIELDS),
        "list": ("parse_failed", docs.NO_FIELDS), "broken": ("parse_failed", docs.BAD_FIELDS),
    }
    wanted = spark.createDataFrame([("ok",), ("gone",), ("new",)], "product string")
    assert sorted(r["product"] for r in docs.unresolved(wanted, df, files).collect()) == ["gone", "new"]
    with pytest.raises(Exception, match="leaves the root"):
        docs.verified(spark.createDataFrame([("x", "../a.pdf", 1, n, sha, "", "", "")], DOCUMENTS), files).collect()


def test_pages_that_the_source_failed_to_make(spark):
    page = "获取参数页发生错误：没有找到参数页".encode()
    files = spark.createDataFrame([("d/p.html", len(page), page), ("d/q.html", 3, b"abc"), ("d/r.html", 9, "获取参数页发生错误".encode())], FILES)
    say = lambda path: f"{docs.NOT_PDF}，已存为 HTML{docs.ORIGINAL}{path}"
    rows = [(1, say("d/p.html")), (2, say("d/q.html")), (3, say("d/r.html")), (4, say("../d/p.html")), (5, say("")), (6, "超时" + docs.ORIGINAL + "d/p.html"), (7, None), (8, say("none"))]
    got = {r.id: r.source_failure for r in docs.source_failures(spark.createDataFrame(rows, "id int, message string"), files).collect()}
    assert got == {k: k == 1 for k in range(1, 9)}
