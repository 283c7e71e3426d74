"""The inventory of listed products, and the ledger of runs, events and articles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.details import is_release
from ..functions.values import parse_date


def inventory(products: DataFrame, business: DataFrame, energies: DataFrame) -> DataFrame:
    """Every listed product with what is known of it: gate, channel, energy, group and state.

    products (product, model, name, batch, batches, trademark, company, category, tag),
    business (product, db_batch, state, fuel), energies (model, label). The business row is
    found by product id, the catalogue's energy by upper-case model code. A product that is
    not of new energy counts in its latest batch that admits such products.
    """
    b = business.select("product", "db_batch", "state", F.col("fuel").alias("known_fuel"))
    e = energies.select(F.upper("model").alias("__model"), F.col("label").alias("catalog_energy"))
    j = products.join(b, "product", "left").join(e, F.upper(F.col("model")) == F.col("__model"), "left")
    found = rules.energy(F.coalesce("known_fuel", F.lit("")), F.col("name"), F.col("model"), F.coalesce("catalog_energy", F.lit("")))
    j = j.withColumn("__e", found)
    admitted = F.array_max(F.filter("batches", lambda x: rules.non_nev_batch(x)))
    plain = ~rules.energy_group(F.col("__e.energy")).eqNullSafe(F.lit("NEV")) & admitted.isNotNull()
    j = j.withColumn("__batch", F.when(plain, admitted).otherwise(F.col("batch")))
    gate = rules.scope(F.col("name"), F.col("category"), F.col("tag"))["gate"]
    return j.select(
        "product", "model", "name", "trademark", "company", F.col("__batch").alias("batch"), F.col("batch").alias("latest_batch"), F.array_sort("batches").alias("batches"),
        rules.channel(F.col("model"), F.col("name"), F.col("category"), F.coalesce("catalog_energy", F.lit("")))["channel"].alias("channel"),
        F.col("__e.energy").alias("energy"), F.col("__e.source").alias("energy_source"), F.coalesce("catalog_energy", F.lit("")).alias("catalog_energy"),
        gate.alias("gate"), rules.inventory_group(gate, F.col("__e.energy"), F.col("__batch")).alias("grp"), F.coalesce("state", F.lit("missing")).alias("state"), "db_batch", "tag",
    )


def with_documents(documents: DataFrame, announcements: DataFrame, vehicles: DataFrame, batches: DataFrame) -> DataFrame:
    """Documents that are PDF with announcement and vehicle, and the batch's name where it is known."""
    return documents.where("is_pdf = 1").join(announcements, "announcement").join(vehicles, "vehicle").join(batches, "batch", "left")


def admitted_energies(rows: DataFrame, catalogue: DataFrame, vague: tuple[str, ...] = ("", "新能源", "新能源汽车")) -> DataFrame:
    """Products whose model has exactly one definite energy of the new kinds in the catalogue.

    rows (product, model), catalogue (model, label). Models are compared as they are.
    """
    definite = catalogue.select("model", F.trim(F.coalesce("label", F.lit(""))).alias("label")).where(~F.col("label").isin(*vague)).distinct()
    e = definite.withColumn("energy", rules.energy(F.lit(""), F.lit(""), F.lit(""), F.col("label"))["energy"])
    one = e.groupBy("model").agg(F.min("energy").alias("energy"), F.max("energy").alias("other")).where("energy = other").drop("other")
    return rows.join(one, "model", "left").withColumn("admitted", F.coalesce(rules.energy_group(F.col("energy")) == "NEV", F.lit(False)))


def registrable(articles: DataFrame, rows: DataFrame, today: Column, latest: Column, days: int = 60, batches: int = 2) -> DataFrame:
    """Catalogue rows to register as events of formal batches: recent articles that name a recent batch, road vehicles only.

    articles (article, title, published, status), rows (article, model, name, category, tag).
    """
    batch = F.regexp_extract("title", r"道路机动车辆生产企业及产品.{0,20}?第\s*(\d+)\s*批", 1)
    a = articles.where("status = 'ok'").withColumn("batch", F.nullif(batch, F.lit("")).cast("bigint")).withColumn("event_date", parse_date(F.coalesce("published", F.lit(""))))
    age = F.date_diff(today, F.col("event_date"))
    a = a.where(F.col("batch").isNotNull() & age.between(0, days) & (F.col("batch") > latest - batches) & (F.col("batch") <= latest))
    gate = rules.scope(F.col("name"), F.col("category"), F.col("tag"))["gate"]
    return a.join(rows, "article").where(~rules.is_non_automotive(F.col("name")) & (gate != "excluded")).select("article", "batch", "event_date", "model", "name")


def releases(articles: DataFrame) -> DataFrame:
    return articles.where(is_release(F.col("title")))


def latest_formal_batch(batches: DataFrame, events: DataFrame) -> DataFrame:
    """The greatest batch of two sources; 0 without any."""
    both = batches.select(F.col("batch").cast("bigint").alias("b")).unionByName(events.where("kind = 'formal'").select(F.col("batch").cast("bigint").alias("b")))
    return both.agg(F.coalesce(F.max("b"), F.lit(0)).alias("batch"))


def resolved_levels(names: DataFrame, levels: DataFrame) -> DataFrame:
    """Level of a ranking for each name: equal, else '全部' and the name, else the first that contains it.

    names (name), levels (level, ordinal): a ranking's levels are few and are read off one array.
    """
    listed = levels.agg(F.array_sort(F.collect_list(F.struct("ordinal", "level"))).alias("__l"))
    all_ = F.transform("__l", lambda x: x["level"])
    broad = F.concat(F.lit("全部"), F.col("name"))
    near = F.get(F.filter(all_, lambda x: (F.col("name") != "") & F.contains(x, F.col("name"))), F.lit(0))
    found = F.when(F.array_contains(all_, F.col("name")), F.col("name")).when(F.array_contains(all_, broad), broad).otherwise(near)
    return names.distinct().join(F.broadcast(listed), how="cross").select("name", found.alias("level"))


def attempts_of_runs(attempts: DataFrame, events: DataFrame) -> DataFrame:
    """Attempts with their events' model, batch and kind."""
    return attempts.join(events, "event").select("run", "event", "model", "batch", "kind", "status")


def problems(run_models: DataFrame, vehicles: DataFrame, shown: int = 50) -> DataFrame:
    """Of every run the first models that aren't done, and how many more there are."""
    w = Window.partitionBy("run")
    j = run_models.where("status <> 'done'").join(vehicles, "vehicle")
    j = j.withColumn("place", F.row_number().over(w.orderBy("status", "code", "vehicle"))).withColumn("remaining", F.greatest(F.lit(0), F.count("*").over(w) - shown))
    return j.where(F.col("place") <= shown).select("run", "place", "code", "status", "remaining")


def backed_off(events: DataFrame, results: DataFrame, today: Column, days: int = 7) -> DataFrame:
    """Events after a check: status, one attempt more, next check ``days`` later; unchecked ones stay."""
    j = events.join(results.select("event", F.col("status").alias("__new")), "event", "left")
    checked = F.col("__new").isNotNull()
    return j.select(
        "event", F.coalesce("__new", "status").alias("status"), (F.col("attempts") + checked.cast("int")).alias("attempts"),
        F.when(checked, F.date_add(today, days)).otherwise(F.col("next_check")).alias("next_check"),
    )


def first_of_identity(rows: DataFrame, order: str) -> DataFrame:
    """Union of queries by batch: of rows equal in (upper-case model, product, batch) the first."""
    key = (F.upper(F.trim(F.coalesce("model", F.lit("")))).alias("model"), F.trim(F.coalesce("product", F.lit(""))).alias("product"), F.trim(F.coalesce("batch", F.lit(""))).alias("batch"))
    return rows.groupBy(*key).agg(F.min(order).alias(order))


def availability(rows: DataFrame) -> DataFrame:
    """Histogram of a snapshot's availability with its distinct photos and series."""
    return rows.groupBy("availability").agg(F.count("*").alias("n"), F.countDistinct("series").alias("series"))


def numbered_paths(rows: DataFrame, path: str, order: str) -> DataFrame:
    """Paths made unique: the second of equal ones becomes name_2.ext, and so on."""
    n = F.row_number().over(Window.partitionBy(path).orderBy(order))
    stem, ext = F.regexp_extract(path, r"^(.*?)(\.[^./]*)?$", 1), F.regexp_extract(path, r"^(.*?)(\.[^./]*)?$", 2)
    return rows.withColumn("unique_path", F.when(n == 1, F.col(path)).otherwise(F.concat(stem, F.lit("_"), n.cast("string"), ext)))


def unfinished(runs: DataFrame) -> DataFrame:
    return runs.where("completed_at is null")


def candidates_first(hits: DataFrame, group: list[str], most: int = 3) -> DataFrame:
    """The candidates to try: highest score first, then the earlier rank."""
    w = Window.partitionBy(*group).orderBy(F.col("score").desc(), "rank")
    return hits.withColumn("place", F.row_number().over(w)).where(F.col("place") <= most)
