"""Fingerprints of documents that add up: homomorphic multiset hashes of paragraphs.

A paragraph (a line) is hashed to a wide vector, and a document's fingerprint is the sum
of its paragraphs' vectors, each lane modulo a power of two. Sums don't depend on order,
so documents with the same paragraphs have equal fingerprints, and a paragraph is put in
or taken out by adding or subtracting its vector (``added``, ``removed``), without the
rest of the text. The vector has two parts:

* ``strong``: eight lanes modulo 2^32, hashes of the whole paragraph. They tell documents
  apart that differ in a paragraph, wherever lines are cut.
* ``lanes``: 128 lanes modulo 2^16, four to a word, which count the set bits of the
  hashes of the paragraph's pieces (a few words each). Twice a lane's count less the
  number of pieces is a sum of random signs, so the product of two documents' lanes
  estimates how many pieces they share; ``likeness`` is shared pieces by all pieces
  (Tanimoto), 1 for equal fingerprints, with a standard error of about 0.05.

``compare`` sets every document against its edited text and the next document, by
descending id. Documents are dealt once, to ranges of keys (id, hash of the text), where
the next one is the row below; a range's first document also goes to the range before it
as a guest, so no row is searched for elsewhere. Keys are counted first, without texts,
which gives even ranges; rows of one id and text that are more than a thousandth of all
are folded into one row before they are dealt and unfolded after.

All of it is DataFrame functions. Pieces are exploded and summed where a range's
documents already are, so their rows are never shuffled.

Cases: null text counts as empty; an empty text has no paragraphs, and two such are
alike with 1; ids that are null stand last, equal ids by their texts' hashes and texts;
rows equal in both follow each other; a table of one document has it as its own next; an
empty table gives no rows. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from ._spark import forget, materialize, partitions, table

#: Pieces end at ASCII punctuation, at ends of lines, and at a blank after a letter from a to m, which goes with it.
PIECES = r"[\n.,;:!?] ?|[a-m] "
STRONG_LANES, STRONG = 8, (1 << 32) - 1
#: Two counts of 32 bits stand in a word while they are summed, four of 16 bits afterwards.
WORDS, HASHES = 32, 2
#: Rows of one id and text are folded from this share of all rows on, and this many.
HOT_SHARE, HOT_ROWS = 1000, 10_000
#: Rows that a folded row is unfolded to at once.
UNFOLDED = 1000
#: Ranges that documents are dealt to, for each shuffle partition; all; and compared at once.
RANGES, MOST_RANGES, STEP = 4, 1 << 16, 256

_TWO, _FOUR = (1 << 32) + 1, (1 << 48) - (1 << 32) + (1 << 16) - 1


def paragraphs(text: Column) -> Column:
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, "\n"))


def units(text: Column, which: int = 0) -> Column:
    """Hashes of a text's paragraphs and pieces, as structs of which, kind and hash; one of kind 0 stands for the text."""
    unit = lambda kind, h: F.struct(F.lit(which).alias("which"), F.lit(kind).alias("kind"), h.alias("hash"))
    pieces = F.filter(F.split(text, PIECES), lambda p: p != "")
    return F.concat(F.array(unit(0, F.lit(0).cast("long"))), F.transform(paragraphs(text), lambda p: unit(1, F.xxhash64(p))), F.transform(pieces, lambda p: unit(2, F.xxhash64(p))))


def summed(df: DataFrame, unit: str, *by: str) -> DataFrame:
    """Fingerprints (column ``vector``) of rows with an exploded ``unit``, by ``by``."""
    of = lambda kind, value: F.when(F.col(f"{unit}.kind") == kind, value).otherwise(F.lit(0).cast("long"))
    h = F.col(f"{unit}.hash")
    flat = df.select(*by, of(1, F.lit(1)).alias("paragraph"), of(2, F.lit(1)).alias("piece"), of(1, h).alias("line"), of(2, h).alias("hash0"), of(2, F.xxhash64(h)).alias("hash1"))
    strong = [F.sum(F.when(F.col("paragraph") == 1, F.xxhash64("line", F.lit(k)).bitwiseAND(F.lit(STRONG))).otherwise(F.lit(0))).alias(f"s{k}") for k in range(STRONG_LANES)]
    counts = [F.sum(F.shiftrightunsigned(f"hash{j}", k).bitwiseAND(F.lit(_TWO))).alias(f"w{j * WORDS + k}") for j in range(HASHES) for k in range(WORDS)]
    found = flat.groupBy(*by).agg(F.sum("paragraph").alias("paragraphs"), F.sum("piece").alias("pieces"), *strong, *counts)
    word = lambda k: F.col(f"w{k}").bitwiseAND(F.lit(_FOUR)).bitwiseOR(F.shiftleft(F.col(f"w{k + 1}").bitwiseAND(F.lit(_FOUR)), 16))
    vector = F.struct(
        "paragraphs", "pieces", F.array(*[F.col(f"s{k}").bitwiseAND(F.lit(STRONG)) for k in range(STRONG_LANES)]).alias("strong"),
        F.array(*[word(k) for k in range(0, WORDS * HASHES, 2)]).alias("lanes"),
    )
    return found.select(*by, vector.alias("vector"))


def _combined(a: Column, b: Column, sign: int) -> Column:
    def two(x: Column, y: Column) -> Column:  # every other lane; what one lends comes from the free bits above it
        return (x.bitwiseAND(F.lit(_FOUR)) + sign * y.bitwiseAND(F.lit(_FOUR)) + (F.lit(_TWO << 16) if sign < 0 else 0)).bitwiseAND(F.lit(_FOUR))

    def four(x: Column, y: Column) -> Column:
        return two(x, y).bitwiseOR(F.shiftleft(two(F.shiftrightunsigned(x, 16), F.shiftrightunsigned(y, 16)), 16))

    return F.struct(
        (a["paragraphs"] + sign * b["paragraphs"]).alias("paragraphs"), (a["pieces"] + sign * b["pieces"]).alias("pieces"),
        F.zip_with(a["strong"], b["strong"], lambda x, y: (x + sign * y).bitwiseAND(F.lit(STRONG))).alias("strong"),
        F.zip_with(a["lanes"], b["lanes"], four).alias("lanes"),
    )


def added(a: Column, b: Column) -> Column:
    """Fingerprint of the paragraphs of both."""
    return _combined(a, b, 1)


def removed(a: Column, b: Column) -> Column:
    """Fingerprint of the paragraphs of ``a`` without those of ``b``."""
    return _combined(a, b, -1)


def digest(fingerprint: Column) -> Column:
    """The fingerprint as text: counts and lanes in hexadecimal, of fixed width."""
    long = F.concat(F.array(fingerprint["paragraphs"], fingerprint["pieces"]), fingerprint["lanes"])
    hexed = lambda words, width: F.transform(words, lambda w: F.lpad(F.lower(F.hex(w)), width, "0"))
    return F.array_join(F.concat(hexed(fingerprint["strong"], 8), hexed(long, 16)), "")


def signs(fingerprint: Column) -> Column:
    """Sums of random signs, one a lane: twice the count less the number of pieces, near zero."""
    n, half = fingerprint["pieces"], 1 << 15
    lane = lambda w, k: F.shiftrightunsigned(w, 16 * k).bitwiseAND(F.lit(2 * half - 1))
    return F.flatten(F.transform(fingerprint["lanes"], lambda w: F.array(*[(2 * lane(w, k) - n + half).bitwiseAND(F.lit(2 * half - 1)) - half for k in range(4)])))


def product(a: Column, b: Column) -> Column:
    """Inner product of two ``signs``."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0).cast("long"), lambda s, x: s + x).cast("double")


def likeness(same: Column, aa: Column, bb: Column, ab: Column) -> Column:
    """Shared pieces by all pieces, 0 to 1, from products; 1 where fingerprints are the ``same``."""
    found = F.when(aa + bb - ab > 0, ab / (aa + bb - ab)).otherwise(F.lit(0.0))
    return F.when(same, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), found)))


def _key() -> Column:
    """Documents stand by this, descending: ids that are null last, equal ids by hash."""
    return F.struct(F.col("doc_id").isNotNull().alias("known"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash"))


def _dealt(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """Adds range and guest: rows of a range stand together, followed by the next range's first as a guest."""
    spark = texts.sparkSession
    n = min(MOST_RANGES, RANGES * partitions(spark))
    first = keys.repartitionByRange(n, F.col("key").desc()).groupBy(F.spark_partition_id()).agg(F.max("key").alias("first"))
    # at most MOST_RANGES keys, put into the plan as one constant
    listed = first.agg(F.to_json(F.sort_array(F.collect_list("first"), asc=False))).first()[0]
    edges = F.from_json(F.lit(listed), ArrayType(keys.schema["key"].dataType))
    tops = F.filter(edges, lambda e, k: k % STEP == 0)
    above = lambda some: F.size(F.filter(some, lambda e: e >= F.col("key"))) - 1
    marked = texts.withColumn("__top", STEP * above(tops)).withColumn("range", F.col("__top") + above(F.slice(edges, F.col("__top") + 1, F.lit(STEP))))
    is_first = F.element_at(edges, F.col("range") + 1) == F.col("key")
    before = F.when(F.col("range") == 0, F.size(edges)).otherwise(F.col("range")) - 1
    own, guest = F.struct(F.col("range"), F.lit(False).alias("guest")), F.struct(before.alias("range"), F.lit(True).alias("guest"))
    places = marked.withColumn("__places", F.when(is_first, F.array(own, guest)).otherwise(F.array(own))).drop("__top", "range")
    return places.withColumn("__place", F.explode("__places")).select("*", "__place.range", "__place.guest").drop("__places", "__place")


def _compared(df: DataFrame, *by: str) -> DataFrame:
    """Rows doc_id, text, next (its text) in order of ``by``, last of all ``guest``, to the result's columns.

    Guests are there for the rows before them.
    """
    n, cut = F.col("n_chars"), F.expr("n_chars div 2")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), (n - cut).cast("int")), F.substring(F.col("next"), F.lit(1), cut.cast("int")))
    texts = df.withColumn("n_chars", F.char_length("text").cast("long")).withColumn("edited", F.when(~F.col("guest"), edited))
    kept = ["doc_id", "n_chars", "edited_sha256"]
    both = F.when(F.col("guest"), units(F.col("text"))).otherwise(F.concat(units(F.col("text")), units(F.col("edited"), 1)))
    each = texts.withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256)).select(*by, *kept, F.explode(both).alias("unit"))
    found = summed(each.withColumn("which", F.col("unit.which")), "unit", *by, "which", *kept)
    signed = found.withColumn("signs", signs(F.col("vector"))).withColumn("norm", product(F.col("signs"), F.col("signs")))
    below = Window.partitionBy(by[0]).orderBy(*by[1:], "which")
    one = F.struct("vector", "signs", "norm")
    pairs = signed.withColumn("changed", F.lead(one, 1).over(below)).withColumn("next", F.lead(one, 2).over(below)).where("which = 0 AND NOT guest")
    near = lambda c: likeness(F.col("vector") == F.col(f"{c}.vector"), F.col("norm"), F.col(f"{c}.norm"), product(F.col("signs"), F.col(f"{c}.signs")))
    return pairs.select(
        *by, *kept, digest(F.col("vector")).alias("fingerprint"), digest(F.col("changed.vector")).alias("edited_fingerprint"),
        near("changed").alias("near_edited"), near("next").alias("near_next"),
    )


def compare(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of documents (doc_id, text)."""
    spark = docs.sparkSession
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("key", _key())
    keys = materialize(texts.groupBy("key").agg(F.count("*").alias("rows")), "fingerprint-keys")
    total = keys.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    hot = keys.where(F.col("rows") > max(HOT_ROWS, total // HOT_SHARE)).select("key")  # at most HOT_SHARE keys
    rows, folded = texts, None
    if not hot.isEmpty():
        copies = texts.join(F.broadcast(hot), "key", "left_semi").groupBy("key", "doc_id", "text").agg(F.count("*").alias("copies"))
        folded = materialize(copies, "fingerprint-folded", lasting=True)
        rows = texts.join(F.broadcast(hot), "key", "left_anti").unionByName(folded.drop("copies"))
    order = Window.partitionBy("range").orderBy("guest", F.col("key").desc(), "text")
    placed = _dealt(rows, keys).withColumn("next", F.lead("text").over(order)).withColumn("place", F.row_number().over(order))
    result = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    found = _compared(placed.drop("key"), "range", "place", "guest").select(*result)
    if folded is None:
        forget(keys)
        return found
    # each copy but the last is followed by its like: as a range of its own, with itself as the guest
    own = folded.where("copies > 1").withColumn("next", F.col("text")).withColumn("guest", F.explode(F.array(F.lit(False), F.lit(True))))
    alike = _compared(own.drop("key").withColumn("range", F.struct("doc_id", F.sha2("text", 256))), "range", "guest", "copies")
    some = alike.withColumn("some", F.explode(F.sequence(F.lit(0), F.expr(f"(copies - 2) div {UNFOLDED}"))))
    spread = some.repartition(partitions(spark), "some", "fingerprint")
    each = spread.withColumn("each", F.explode(F.sequence(F.lit(1), F.least(F.lit(UNFOLDED), F.col("copies") - 1 - F.col("some") * UNFOLDED))))
    return found.unionByName(each.select(*result))


def op11_document_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare(table(spark, sf_dir, "documents"))


ORACLES: dict[str, str] = {}
QUERIES = {"op11_document_fingerprint": op11_document_fingerprint}
