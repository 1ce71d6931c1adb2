"""The build: keyed source documents to final records, as one plan over DataFrames.

Stages: taxonomy (inclusion, match cascade, unmatched species appended, sound classes), overlays
of identifiers, names, images and descriptions, alias pruning, overrides, quality, ids. Every
stage is joins and aggregates; the id registry is the only state.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaloom.functions import maps
from taxaloom.functions import text as T
from taxaloom.operators import merge, ordering, quality, resolve
from taxaloom.session import checkpoint
from taxaloom.sources import storage

IDS = ["inat_id", "ebird_code", "gbif_id", "ncbi_id", "avibase_id", "birdlife_id", "ml_taxon_code", "xc_name", "observationorg_id"]


@dataclass
class Sources:
    """Source tables with the schemas of `sources.files.SCHEMAS` (key scientific_name, and ord)."""

    inat: DataFrame
    checklist: DataFrame
    ebird: DataFrame
    wikidata: DataFrame
    wikipedia: DataFrame
    macaulay: DataFrame
    xc: DataFrame
    observationorg: DataFrame
    translate: DataFrame
    sound_classes: DataFrame
    ebird_names: DataFrame  # code, locale, name
    overrides: DataFrame
    aliases: DataFrame  # scientific_name, alias
    groups: list[str] = field(default_factory=list)


def included(inat: DataFrame, groups: list[str]) -> DataFrame:
    """Rows with the first reason that leaves them out (null: included)."""
    bad_group = ~F.col("taxon_group").isin(groups) if groups else F.lit(False)
    reason = (
        F.when(F.col("inat_id").isNull(), "no_id").when(~T.is_binomial("scientific_name"), "not_species")
        .when(F.coalesce("extinct", F.lit(False)), "extinct").when(F.coalesce(bad_group, F.lit(True)), "group")
    )
    return inat.withColumn("reason", reason)


def taxonomy(s: Sources) -> DataFrame:
    """One row per species: matched rows of the first source, unmatched checklist species, sound classes."""
    inat = included(s.inat, s.groups).where("reason is null")
    birds = inat.where("taxon_group = 'Aves'").select(F.col("ord").cast("bigint").alias("ord"), F.col("scientific_name").alias("name"), F.col("preferred_common_name").alias("english"))
    links = s.wikidata.where("ebird_code <> ''").select(F.col("scientific_name").alias("name"), F.col("ebird_code").alias("code"))
    claims = resolve.match_cascade(birds, s.checklist, links).select(F.col("ord").alias("_o"), "claim", F.col("source").alias("match_source"))
    owner = ordering.last_wins(s.checklist, ["name"], "ord", ["code", "english", "english_clements"]).withColumnsRenamed({"name": "claim", "english": "checklist_english"})
    d = inat.join(claims, F.col("ord") == F.col("_o"), "left").drop("_o").join(owner, "claim", "left")
    d = d.where("taxon_group <> 'Aves' or match_source is not null")
    displayed = F.col("match_source").isin("direct", "named")
    d = d.select(
        F.col("ord").cast("bigint").alias("ord"), "scientific_name", "inat_id", "taxon_group", F.lit("species").alias("record_type"),
        T.null_to_blank(F.when(displayed, F.col("checklist_english")).otherwise(F.col("preferred_common_name"))).alias("common_name"),
        F.when(displayed & (F.col("english_clements") != F.col("checklist_english")), F.col("english_clements")).otherwise("").alias("common_name_alt"),
        F.transform_keys(maps._safe("common_names"), lambda k, v: T.normalize_locale(k)).alias("base_names"), T.null_to_blank("code").alias("ebird_code"),
        F.coalesce(F.col("match_source"), F.lit("non_bird")).alias("match_source"), "claim", "observations_count", "image_url", "image_attribution", "image_license", "obs_photo",
    )
    claimed = d.where("claim is not null").select(F.col("claim").alias("name"))
    extra = s.checklist.join(claimed, "name", "left_anti").join(d.select(F.col("scientific_name").alias("name")), "name", "left_anti")
    extra = ordering.first_wins(extra, ["name"], "ord", ["ord", "code", "english"]).select(
        (F.col("ord") + F.lit(1 << 40)).alias("ord"), F.col("name").alias("scientific_name"), F.lit("Aves").alias("taxon_group"), F.lit("species").alias("record_type"),
        T.null_to_blank("english").alias("common_name"), F.lit("").alias("common_name_alt"), F.col("code").alias("ebird_code"), F.lit("checklist_only").alias("match_source"),
    )
    sound = s.sound_classes.select(
        (F.col("ord") + F.lit(1 << 41)).cast("bigint").alias("ord"), "scientific_name", "taxon_group", F.lit("sound_class").alias("record_type"),
        F.coalesce("common_name", "scientific_name").alias("common_name"), F.lit("").alias("common_name_alt"), F.col("common_names").alias("base_names"), F.lit("").alias("ebird_code"), F.lit("sound_class").alias("match_source"), "image_url",
    )
    species = d.drop("claim").unionByName(extra, allowMissingColumns=True)
    return species.join(sound.select("scientific_name"), "scientific_name", "left_anti").unionByName(sound, allowMissingColumns=True)


def records(s: Sources) -> DataFrame:
    """Final records without ids, scored."""
    t = taxonomy(s)
    w = s.wikidata.select("scientific_name", *[F.col(c).alias(f"_{c}") for c in ("ebird_code", "gbif_id", "ncbi_id", "avibase_id", "birdlife_id", "labels", "image")], F.col("aliases").alias("_wa"))
    d = t.join(w, "scientific_name", "left")
    for x, c in ((s.macaulay, "ml_taxon_code"), (s.xc, "xc_name"), (s.observationorg, "observationorg_id")):
        d = d.join(x.select("scientific_name", c, F.col("aliases").alias(f"_a_{c}")), "scientific_name", "left")
    bird = F.col("taxon_group") == "Aves"
    d = d.withColumns({
        "ebird_code": F.coalesce(F.nullif("ebird_code", F.lit("")), F.when(bird, F.col("_ebird_code")), F.lit("")),
        "gbif_id": F.col("_gbif_id"), "ncbi_id": F.col("_ncbi_id"),
        "avibase_id": F.when(bird, F.col("_avibase_id")), "birdlife_id": F.when(bird, F.col("_birdlife_id")),
    })
    en = s.ebird_names.where("locale = 'en'").select("code", F.col("name").alias("_en"))
    local = s.ebird_names.where("locale <> 'en' and name <> ''").join(en, "code", "left").where("_en is null or name <> _en")
    local = local.groupBy("code").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(T.normalize_locale("locale"), "name")))).alias("_ebird_names"))
    d = d.join(local.withColumnRenamed("code", "ebird_code"), "ebird_code", "left")
    d = d.withColumn("common_names", merge.merge_names(d, "base_names", "_ebird_names", "_labels", F.when(F.col("record_type") == "species", F.col("common_name"))))
    e = ordering.last_wins(s.ebird.where("ebird_code <> '' and image_url <> ''"), ["ebird_code"], "ord", ["image_url", "image_attribution"]).withColumnsRenamed({"image_url": "_eu", "image_attribution": "_ea"})
    d = d.join(e, "ebird_code", "left")
    free = F.lower(F.coalesce("image_license", F.lit(""))).isin(*T.LICENCES)
    photo = F.coalesce(F.lower(F.col("obs_photo.license")).isin(*T.LICENCES), F.lit(False))
    d = d.withColumn("image", merge.first_image([("inat", F.col("image_url"), free), ("ebird", F.col("_eu"), F.lit(True)), ("wikimedia", F.col("_image.url"), T.is_free_licence("_image.license")), ("inat_observation", F.col("obs_photo.url"), photo), ("sound_class", F.col("image_url"), F.col("record_type") == "sound_class")]))
    line = F.when(F.col("image.source") == "ebird", F.col("_ea")).when(F.col("image.source") == "wikimedia", F.col("_image.attribution")).when(F.col("image.source") == "inat_observation", F.col("obs_photo.attribution")).otherwise(F.col("image_attribution"))
    d = d.withColumns({"image_author": T.image_author(line, F.when(F.col("image.source").startswith("inat"), "inat").otherwise(F.col("image.source"))), "image_source": F.coalesce("image.source", F.lit("")), "image_url": F.coalesce("image.url", F.lit(""))})
    wiki = s.wikipedia.select("scientific_name", "wikipedia_urls", merge.merge_first_wins(F.when(F.coalesce("extract", F.lit("")) != "", F.create_map(F.lit("en"), F.col("extract"))), F.col("extracts")).alias("_wiki"))
    text = s.ebird.where("description <> ''").groupBy("ebird_code").agg(F.max_by("description", "ord").alias("_etext"))
    d = d.join(wiki, "scientific_name", "left").join(text, "ebird_code", "left").join(s.translate.select("scientific_name", F.col("extracts").alias("_llm")), "scientific_name", "left")
    d = merge.merge_descriptions(d, "_wiki", "_etext", "_llm")
    d = merge.override(d, s.overrides.select("scientific_name", "image_url", "image_author", "image_source"), "scientific_name", ["image_url", "image_author", "image_source"])
    none = F.array().cast("array<string>")
    found = F.concat(*[F.coalesce(c, none) for c in ("_wa", "_a_ml_taxon_code", "_a_xc_name", "_a_observationorg_id")])
    manual = s.aliases.groupBy("scientific_name").agg(F.sort_array(F.collect_list("alias")).alias("_manual"))
    a = d.select("scientific_name", maps.ordered_distinct(found, T.is_clean_scientific_name).alias("_found")).join(manual, "scientific_name", "left")
    kept = merge.prune_aliases(a, "scientific_name", "_found", "_manual").groupBy("scientific_name").agg(F.transform(F.sort_array(F.collect_list(F.struct("ord", "alias"))), lambda x: x["alias"]).alias("scientific_name_aliases"))
    d = d.join(kept, "scientific_name", "left").withColumn("scientific_name_aliases", F.coalesce("scientific_name_aliases", none))
    d = d.select("ord", "scientific_name", "common_name", "common_name_alt", "taxon_group", "record_type", "match_source", "common_names", "descriptions", "description_source", "description_sources", "wikipedia_urls", "scientific_name_aliases", *IDS, "observations_count", "image_url", "image_author", "image_source")
    return quality.score(d, IDS, IDS[1:])


def finish(scored: DataFrame, registry: DataFrame, least: int = 20, by_group: dict[str, int] | None = None) -> tuple[DataFrame, DataFrame]:
    """(records with ids, registry): pruned by quality, known species keep their id, new ones continue."""
    kept = quality.drop_reasons(scored, least, by_group or {"Insecta": 35}).where(F.size("drop_reasons") == 0).drop("drop_reasons")
    ids = ordering.assign_ids(kept.select("scientific_name", "ord"), registry, "scientific_name", "ord")
    out = kept.join(ids, "scientific_name").withColumn("birdnet_id", T.record_id("number")).drop("number")
    new = ids.join(registry.select("scientific_name"), "scientific_name", "left_anti")
    return out, registry.select("scientific_name", F.col("number").cast("bigint").alias("number")).unionByName(new)


def kept_taxonomy(spark, path: str, make, merge_only: bool = False) -> DataFrame:
    """The taxonomy from its table at `path`, made and written first unless `merge_only` asks for the written one.

    `make` is called only where the taxonomy is made. With `merge_only` a missing table raises.
    """
    if not merge_only:
        make().write.mode("overwrite").parquet(path)
    elif not storage.exists(spark, path):
        raise FileNotFoundError(f"{path} is missing; build the taxonomy once before merging only")
    return spark.read.parquet(path)


def read_registry(spark, path: str) -> DataFrame:
    """(scientific_name, number) of all ids given so far; empty where none were."""
    return spark.read.parquet(path) if storage.exists(spark, path) else spark.createDataFrame([], "scientific_name string, number bigint")


def grow_registry(spark, path: str, registry: DataFrame) -> int:
    """Append the ids that the table at `path` doesn't have; nothing is written where there are none. The number added."""
    new = checkpoint(registry.join(read_registry(spark, path).select("scientific_name"), "scientific_name", "left_anti").select("scientific_name", "number"))
    n = new.count()
    if n:
        new.write.mode("append").parquet(path)
    return n


def delivered(records: DataFrame) -> DataFrame:
    """Final records in the order of their id as text."""
    return records.orderBy("birdnet_id")
