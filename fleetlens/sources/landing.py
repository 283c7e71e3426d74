"""Landed files: batch caches, reviews, words, profiles, manifests and file listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.rules import product_id
from ..functions.text import first_filled, norm_model
from ..operators.recovery import profile_actions, profile_keys

PRODUCT = "cpid string, gid string, clxh string, clmc string, gppc string, pc string, dataTag string, cpsb string, qymc string"
CACHE = f"batch int, cache_version int, complete boolean, absent_upstream boolean, fetched_at string, failures array<string>, verify_prefixes array<string>, verify_missed int, products array<struct<{PRODUCT.replace(' string', ':string')}>>"
REVIEWS = "series_id string, series_name string, koubei struct<average:string,rowcount:int,pricerange:string,levelname:string,seriesScoreList:array<struct<typeName:string,score:double>>,reviews:array<struct<specname:string,location:string,posttime:string,buyprice:string,contents:array<struct<structuredname:string,content:string>>>>>"
WORDS = "words array<struct<text:string,x0:double,x1:double,top:double>>"
PROFILE = "name string, aliases array<string>, gonggao struct<trademark:string,filters:map<string,string>,model_prefixes:array<string>,exclude_model_prefixes:array<string>>, trademark string, filters map<string,string>, model_prefixes array<string>, exclude_model_prefixes array<string>"


def json_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One row per JSON file, with its name; malformed files have nulls and the raw text in _corrupt."""
    return spark.read.schema(schema + ", _corrupt string").option("multiLine", True).option("columnNameOfCorruptRecord", "_corrupt").json(path).withColumn("file", F.col("_metadata.file_name"))


def caches(spark: SparkSession, path: str) -> DataFrame:
    """Batch caches, one row per file; partial and absent ones are told by their names."""
    c = json_documents(spark, path, CACHE)
    return c.withColumn("kind", F.when(F.col("file").endswith(".partial.json"), "partial").when(F.col("file").endswith(".absent.json"), "absent").otherwise("complete"))


def cache_products(caches_: DataFrame) -> DataFrame:
    """Product rows of caches with id, model and batch by their first filled names."""
    p = caches_.select("batch", "file", F.posexplode("products").alias("ordinal", "p")).select("batch", "file", "ordinal", "p.*")
    return p.withColumn("product", product_id(F.col("cpid"), F.col("gid"))).withColumn("model", norm_model(F.col("clxh"))).withColumn("row_batch", first_filled(F.col("gppc"), F.col("pc")).try_cast("int"))


def review_texts(reviews: DataFrame) -> DataFrame:
    """Sections of reviews: series, ordinal, section name and text."""
    r = reviews.select("series_name", F.posexplode("koubei.reviews").alias("review", "r"))
    c = r.select("series_name", "review", F.posexplode("r.contents").alias("part", "c"))
    return c.select("series_name", (F.col("review") * 1000 + F.col("part")).alias("ordinal"), F.col("c.structuredname").alias("section"), F.trim("c.content").alias("text")).where("text <> ''")


def review_profiles(reviews: DataFrame) -> DataFrame:
    k = F.col("koubei")
    return reviews.select(
        "series_id", first_filled(F.col("series_name")).alias("series_name"), k["average"].try_cast("double").alias("score"), k["rowcount"].alias("reviews"), k["pricerange"].alias("price_range"),
        F.regexp_extract(F.coalesce(k["pricerange"], F.lit("")), r"\d+(?:\.\d+)?", 0).try_cast("double").alias("low_price"),
        F.transform(k["seriesScoreList"], lambda x, i: F.struct(x["typeName"].alias("dim"), x["score"].alias("score"), i.alias("ordinal"))).alias("dims"),
    )


def profiles(spark: SparkSession, path: str) -> DataFrame:
    """Vehicle profiles, nested or in the old flat form, with every key they answer to."""
    p = spark.read.schema(PROFILE).option("multiLine", True).json(path)

    def either(c: str) -> Column:
        return F.coalesce(F.col(f"gonggao.{c}"), F.col(c))

    keys = profile_keys(F.col("name"), F.col("aliases"))
    return p.select("name", "aliases", *(either(c).alias(c) for c in ("trademark", "filters", "model_prefixes", "exclude_model_prefixes")), keys.alias("keys"))


def upsert_profiles(old: DataFrame, new: DataFrame, overwrite: bool = True) -> DataFrame:
    """Profiles after an update: a new one takes the place of the first that shares a key with it, or is added.

    old (ordinal and the profile's columns), new (the profile's columns). Without overwrite
    known ones stay. Of new profiles with one place the first by name gets it.
    """
    acted = profile_actions(old, new, overwrite)
    place = F.struct("target", F.when(F.col("target").isNull(), F.col("name")))
    placed = acted.withColumn("__n", F.row_number().over(Window.partitionBy(place).orderBy("name")))
    put = placed.where("action <> 'skipped' and (target is null or __n = 1)").withColumnRenamed("target", "ordinal").drop("action", "__n")
    replaced = put.where("ordinal is not null").select("ordinal")
    return old.join(replaced, "ordinal", "left_anti").unionByName(put, allowMissingColumns=True)


def model_list(spark: SparkSession, path: str) -> DataFrame:
    """Model codes of a text file: one a line, '#' starts a comment, first of equal ones."""
    lines = spark.read.text(path).withColumn("ordinal", F.monotonically_increasing_id())
    code = F.upper(F.trim(F.substring_index("value", "#", 1)))
    return lines.select(code.alias("model"), "ordinal").where("model <> ''").groupBy("model").agg(F.min("ordinal").alias("ordinal"))


def files(spark: SparkSession, path: str, magic: int = 4) -> DataFrame:
    """Path, size, first bytes and SHA-256 of files below a folder."""
    b = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return b.select("path", "length", F.substring("content", 1, magic).cast("string").alias("magic"), F.sha2("content", 256).alias("sha256"), "modificationTime")


def manifest(spark: SparkSession, path: str, sha256: str, expected: int) -> DataFrame:
    """Products of a frozen manifest; fails unless its digest and its number of products are as stated."""
    raw = spark.read.format("binaryFile").load(path)
    checked = raw.where(F.assert_true(F.sha2("content", 256) == sha256, "manifest has another digest").isNull())
    parsed = checked.select(F.from_json(F.col("content").cast("string"), f"products array<struct<{PRODUCT.replace(' string', ':string')}>>").alias("m"))
    counted = parsed.where(F.assert_true(F.size("m.products") == expected, "manifest has another number of products").isNull())
    return counted.select(F.explode("m.products").alias("p")).select("p.*")


def config_params(spark: SparkSession, payloads: DataFrame, column: str = "payload") -> DataFrame:
    """Long parameters (section, param, spec, value) of configuration JSON: titles times specs."""
    schema = "titles array<struct<section:string,items:array<struct<id:int,name:string>>>>, specs array<struct<specid:string,specname:string,values:array<struct<id:int,value:string>>>>"
    p = payloads.select(F.from_json(column, schema).alias("j"))
    titles = F.flatten(F.transform("j.titles", lambda t: F.transform(t["items"], lambda i: F.struct(t["section"].alias("section"), i["id"].alias("id"), i["name"].alias("param")))))
    grid = p.select("j", F.explode(titles).alias("t")).select("t.*", F.posexplode("j.specs").alias("ordinal", "s"))
    value = F.get(F.filter("s.values", lambda v: v["id"] == F.col("id")), 0)["value"]
    return grid.where("id > 3").select("section", "param", F.col("s.specid").alias("spec"), "ordinal", F.coalesce(value, F.lit("-")).alias("value"))
