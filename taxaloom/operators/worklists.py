"""Worklists: which species to fetch, translate, shorten or match, and what comes of the results.

Sources are DataFrames with `scientific_name` and the delivered order `ord`; checklists have `name`.
Every list is joins, filters and aggregates; where an order or a limit over a whole list matters, rows are
numbered through range partitions. Null names are in no list; empty sources give empty lists.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaloom.functions import maps
from taxaloom.functions import text as T
from taxaloom.operators.ordering import first_wins, global_rank, last_wins

#: Locales of the taxonomy service that keep their name, and those that are renamed.
TAXONOMY_LOCALES = (
    "af ar bg bn ca cs da de el es es_AR es_CL es_CR es_CU es_DO es_EC es_ES es_MX es_PA es_PR et eu fa fi fr gl gu "
    "he hi hr hu hy is it ja ka kk kn ko lt lv ml mn mr nl no pl pt_PT ro ru sk sl sq sr sv te th tr uk zh_TRA zu"
).split()
RENAMED_LOCALES = {"pt_BR": "pt", "zh_SIM": "zh"}

TRANSLATION = "struct<source_locale:string,service:string,source:string>"


def _none() -> Column:
    return F.array().cast("array<string>")


def canonical_locale(c) -> Column:
    """The locale under which names of a taxonomy locale are kept; null for locales that the service doesn't have."""
    x = T.col(c)
    renamed = reduce(lambda w, kv: w.when(x == kv[0], kv[1]), RENAMED_LOCALES.items(), F.when(F.lit(False), ""))
    return F.coalesce(renamed, F.when(x.isin(*TAXONOMY_LOCALES), x))


def names_by_code(names: DataFrame) -> DataFrame:
    """(code, names): English names as the baseline, and of each locale what differs from it.

    names(code, locale, name), where a later row (by `ord`) of a code and locale counts.
    """
    d = last_wins(names.where("code is not null and name is not null and name <> ''"), ["code", "locale"], "ord", ["name"])
    en = d.where("locale = 'en'").select("code", F.col("name").alias("_en"))
    local = d.where("locale <> 'en'").withColumn("locale", canonical_locale("locale")).where("locale is not null").join(en, "code", "left").where("_en is null or name <> _en")
    both = local.select("code", "locale", "name").unionByName(en.select("code", F.lit("en").alias("locale"), F.col("_en").alias("name")))
    return both.groupBy("code").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("locale", "name")))).alias("names"))


def with_aliases(species: DataFrame, manual: DataFrame) -> DataFrame:
    """Species with their own and the reviewed aliases (scientific_name, alias), clean and each once."""
    m = manual.where(T.is_clean_scientific_name("scientific_name") & T.is_clean_scientific_name("alias"))
    m = m.groupBy("scientific_name").agg(F.transform(F.sort_array(F.collect_list(F.struct("line", "alias"))), lambda x: x["alias"]).alias("_manual"))
    own = F.coalesce("scientific_name_aliases", _none()) if "scientific_name_aliases" in species.columns else _none()
    d = species.join(m, "scientific_name", "left")
    all_ = maps.ordered_distinct_ci(F.concat(own, F.coalesce("_manual", _none())), T.is_clean_scientific_name)
    return d.withColumn("scientific_name_aliases", all_).drop("_manual")


def species_worklist(taxonomy: DataFrame | None, inat: DataFrame, checklist: DataFrame, manual: DataFrame, group: str = "") -> DataFrame:
    """(scientific_name, taxon_group, common_name, ebird_code, scientific_name_aliases) of all species to work on.

    The built taxonomy where there is one; else the first source, and checklist species (birds) that it lacks.
    """
    columns = ["scientific_name", "taxon_group", "common_name", "ebird_code", "scientific_name_aliases", "ord"]

    def shaped(d: DataFrame) -> DataFrame:
        kinds = {"scientific_name_aliases": "array<string>", "ord": "bigint"}
        return d.select(*[F.col(c).cast(kinds.get(c, "string")).alias(c) if c in d.columns else F.lit(None).cast(kinds.get(c, "string")).alias(c) for c in columns])

    if taxonomy is not None:
        parts = [shaped(taxonomy)]
    else:
        birds = checklist.select(F.col("name").alias("scientific_name"), F.lit("Aves").alias("taxon_group"), F.col("english").alias("common_name"), F.col("code").alias("ebird_code"), "ord")
        parts = [shaped(inat), shaped(birds).withColumn("ord", F.col("ord") + F.lit(1 << 40))]
    d = reduce(DataFrame.unionByName, parts).where(T.is_clean_scientific_name("scientific_name"))
    if group:
        d = d.where(F.col("taxon_group") == group)
    d = first_wins(d, ["scientific_name"], "ord", columns[1:])
    return with_aliases(d, manual).drop("ord")


def codes_by_species(inat: DataFrame, checklist: DataFrame) -> DataFrame:
    """(scientific_name, ebird_code): codes of the first source's species with an id, then those of the checklist."""
    own = last_wins(inat.where("inat_id is not null"), ["scientific_name"], "ord", ["ebird_code"]).select("scientific_name", F.trim("ebird_code").alias("ebird_code")).where("ebird_code <> ''")
    listed = first_wins(checklist.where("name <> '' and code <> ''"), ["name"], "ord", ["code"]).select(F.col("name").alias("scientific_name"), F.col("code").alias("ebird_code"))
    return own.unionByName(listed.join(own.select("scientific_name"), "scientific_name", "left_anti"))


def pages_by_species(inat: DataFrame) -> DataFrame:
    """(scientific_name, wikipedia_url) of species with an id and a page."""
    d = inat.where("inat_id is not null").where(T.is_binomial("scientific_name"))
    return last_wins(d, ["scientific_name"], "ord", ["wikipedia_url"]).select("scientific_name", T.blank_to_null("wikipedia_url").alias("wikipedia_url")).where("wikipedia_url is not null")


def ids_by_species(inat: DataFrame, checklist: DataFrame) -> DataFrame:
    """(scientific_name, inat_id) of all species; those of the checklist alone have no id."""
    own = last_wins(inat.where("inat_id is not null").where(T.is_binomial("scientific_name")), ["scientific_name"], "ord", ["inat_id"])
    listed = checklist.where("name <> ''").select(F.col("name").alias("scientific_name")).distinct().join(own.select("scientific_name"), "scientific_name", "left_anti")
    return own.unionByName(listed.withColumn("inat_id", F.lit(None).cast("bigint")))


def observation_counts(inat: DataFrame) -> DataFrame:
    """(scientific_name, observations): 0 where none is known."""
    return last_wins(inat.where("scientific_name is not null"), ["scientific_name"], "ord", ["observations_count"]).select("scientific_name", F.coalesce("observations_count", F.lit(0)).alias("observations"))


def over_thresholds(counted: DataFrame, sounds: int = 0, total: int = 0) -> DataFrame:
    """Rows with enough sound observations, or (where `total` is given) enough observations at all."""
    by_sound = F.coalesce("sound_observations_count", F.lit(0)) >= sounds
    return counted.where(by_sound | (F.coalesce("observations_count", F.lit(0)) >= total) if total else by_sound)


def fetched_only(fetched: DataFrame, requested: DataFrame, key: str) -> DataFrame:
    """Rows of an answer that were asked for, each id once; what else a service sends along is left out."""
    return fetched.join(requested.select(key).distinct(), key, "left_semi")


def by_file(images: DataFrame, file: str = "file", owner: str = "scientific_name") -> DataFrame:
    """(file, owners): all species of each file, in order."""
    d = images.where(F.col(file).isNotNull() & F.col(owner).isNotNull()).select(file, owner).distinct()
    return d.groupBy(file).agg(F.sort_array(F.collect_list(owner)).alias("owners"))


def orphans(files: DataFrame, expected: DataFrame, name: str = "file") -> DataFrame:
    """Files that no record expects."""
    return files.select(name).distinct().join(expected.select(name), name, "left_anti")


def target_locales(wanted: str, default: list[str]) -> list[str]:
    """Locales named (or, for '' and 'all', the default ones), each once, without English."""
    named = default if wanted in ("", "all") else wanted.split(",")
    return [x for x in dict.fromkeys(n.strip() for n in named) if x and x != "en"]


def translation_work(texts: DataFrame, locales: list[str], least_words: int, counts: DataFrame | None = None) -> DataFrame:
    """(scientific_name, locale, english, turn): texts to translate, the species seen most often first.

    texts(scientific_name, extract, extracts, ord). English texts of fewer than `least_words` words wait. Equal counts
    keep the delivered order, and a species' locales the order they are named in.
    """
    en = F.coalesce(F.nullif("extract", F.lit("")), maps.value("extracts", "en"))
    d = texts.select("scientific_name", "ord", "extracts", en.alias("english")).where(T.word_count("english") >= least_words)
    d = d.join(counts, "scientific_name", "left") if counts is not None else d.withColumn("observations", F.lit(0))
    d = d.select("*", F.posexplode(F.array(*[F.lit(x) for x in locales]).cast("array<string>")).alias("_p", "locale")).where(maps._safe("extracts")[F.col("locale")].isNull() | (F.element_at(maps._safe("extracts"), F.col("locale")) == ""))
    d = d.withColumn("_seen", F.coalesce("observations", F.lit(0)))
    return global_rank(d, [F.desc("_seen"), F.asc("ord"), F.asc("_p")], "turn").select("scientific_name", "locale", "english", "turn")


def generation_work(texts: DataFrame, existing: DataFrame, locales: list[str], most_words: int, fallback: bool = True, limit: int | None = None) -> DataFrame:
    """(phase, scientific_name, locale, missing, sources, turn): texts to shorten, translate, or write from other languages.

    texts(scientific_name, extract, extracts, ord), existing(scientific_name, extracts) as generated before and never made
    again. Phase 1: a text of more than `most_words` words; 2: a species with an English text and the locales that
    neither has; 3: a species without an English text and the locales that have one. A limit is one budget over
    the phases in this order.
    """
    d = texts.join(existing.select("scientific_name", F.col("extracts").alias("_made")), "scientific_name", "left")
    d = d.select("scientific_name", "ord", maps.without_blank("extracts").alias("has"), maps.without_blank("_made").alias("made"), F.nullif("extract", F.lit("")).alias("extract"))
    en = F.coalesce("extract", F.element_at("has", "en"))
    shorten = d.select("scientific_name", "ord", "made", F.explode("has").alias("locale", "text"))
    shorten = shorten.where(~F.map_contains_key("made", F.col("locale")) & (T.word_count("text") > most_words)).select(F.lit(1).alias("phase"), "scientific_name", "ord", "locale", _none().alias("missing"), _none().alias("sources"))
    lacks = F.filter(F.array(*[F.lit(x) for x in locales]).cast("array<string>"), lambda x: ~F.map_contains_key("has", x) & ~F.map_contains_key("made", x))
    translate = d.where(en.isNotNull()).select(F.lit(2).alias("phase"), "scientific_name", "ord", F.lit("en").alias("locale"), lacks.alias("missing"), _none().alias("sources")).where(F.size("missing") > 0)
    parts = [shorten, translate]
    if fallback:
        other = F.array_sort(F.filter(F.map_keys("has"), lambda x: x != "en"))
        parts.append(d.where(en.isNull() & ~F.map_contains_key("made", F.lit("en"))).select(F.lit(3).alias("phase"), "scientific_name", "ord", F.lit("en").alias("locale"), _none().alias("missing"), other.alias("sources")).where(F.size("sources") > 0))
    out = global_rank(reduce(DataFrame.unionByName, parts), [F.col("phase"), F.col("ord"), F.col("locale")], "turn").drop("ord")
    return out.where(F.col("turn") <= limit) if limit else out


def store_translations(texts: DataFrame, results: DataFrame) -> DataFrame:
    """Texts with results put in, their sources, and how each came about; species that are new are added.

    texts(scientific_name, extracts, extract_sources, translation), results(scientific_name, locale, text, source, service, ord):
    the last result of a locale counts.
    """
    r = last_wins(results.where("scientific_name is not null and locale is not null"), ["scientific_name", "locale"], "ord", ["text", "source", "service"])
    note = F.struct(F.lit("en").alias("source_locale"), "service", "source")
    entry = lambda value: F.map_from_entries(F.sort_array(F.collect_list(F.struct("locale", value))))
    r = r.groupBy("scientific_name").agg(entry(F.col("text").alias("v")).alias("_e"), entry(F.col("source").alias("v")).alias("_s"), entry(note.alias("v")).alias("_t"))
    d = texts.join(r, "scientific_name", "full_outer")
    none = {"extracts": maps.MAP, "extract_sources": maps.MAP, "translation": f"map<string,{TRANSLATION}>"}
    put = lambda c, new: F.map_concat(F.coalesce(c, F.create_map().cast(none[c])), F.coalesce(new, F.create_map().cast(none[c]))).alias(c)
    return d.select("scientific_name", *[c for c in texts.columns if c not in ("scientific_name", *none)], put("extracts", "_e"), put("extract_sources", "_s"), put("translation", "_t"))


def work_by_locale(work: DataFrame, most: int = 10) -> DataFrame:
    """(locale, n): the locales with most work, ties by name."""
    return work.groupBy("locale").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "locale").limit(most)


def resolve_in_steps(species: DataFrame, steps: list[tuple[str, DataFrame]], synonyms: DataFrame | None, known: DataFrame) -> DataFrame:
    """(scientific_name, value, step, matched_name): identifiers by the first step that has one, then by a synonym.

    Each step is (name, DataFrame(scientific_name, value)); `known` (name, value) is what synonyms are looked up in, the
    first known one of a species counting, in the order `pos`. Species that nothing resolves have nulls, so that they
    are not asked for again. All steps are joined at once and the first is chosen by row.
    """
    d = species.select("scientific_name").distinct()
    for i, (_, s) in enumerate(steps):
        one = s.where("value is not null and value <> ''").groupBy("scientific_name").agg(F.min("value").alias(f"_v{i}"))
        d = d.join(one, "scientific_name", "left")
    values = [F.col(f"_v{i}") for i in range(len(steps))]
    if synonyms is not None:
        k = known.where("name is not null and value is not null and value <> ''").groupBy("name").agg(F.min("value").alias("value"))
        by = synonyms.join(k, F.col("synonym") == F.col("name")).groupBy("scientific_name").agg(F.min_by(F.struct("synonym", "value"), "pos").alias("_syn"))
        d = d.join(by, "scientific_name", "left")
    else:
        d = d.withColumn("_syn", F.lit(None).cast("struct<synonym:string,value:string>"))
    step = reduce(lambda w, x: w.when(x[1].isNotNull(), x[0]), zip([n for n, _ in steps], values), F.when(F.lit(False), ""))
    step = F.coalesce(step, F.when(F.col("_syn").isNotNull(), F.lit("synonym")))
    first = F.coalesce(*values)
    return d.select("scientific_name", F.coalesce(first, F.col("_syn.value")).alias("value"), step.alias("step"), F.when(first.isNull(), F.col("_syn.synonym")).alias("matched_name"))


def configured_classes(spark, entries: list[dict]) -> DataFrame:
    """Sound classes of the configuration: name and group are required and names must be clean; raises otherwise."""
    rows = []
    for i, e in enumerate(entries):
        name, group = str(e.get("name") or "").strip(), str(e.get("group") or "").strip()
        if not name or not group:
            raise ValueError(f"sound class {i + 1} needs a name and a group")
        rows.append((i, name, group, str(e.get("wikidata_qid") or "").strip(), str(e.get("image_file") or "").strip(), list(e.get("aliases") or []), list(e.get("scientific_aliases") or [])))
    d = spark.createDataFrame(rows, "ord int, name string, taxon_group string, wikidata_qid string, image_file string, aliases array<string>, scientific_aliases array<string>")
    bad = [r.name for r in d.where(~T.is_clean_common_name("name")).orderBy("ord").limit(20).collect()]
    if bad:
        raise ValueError(f"sound class names not clean: {', '.join(bad)}")
    return d.withColumns({c: maps.ordered_distinct_ci(c, T.is_clean_common_name) for c in ("aliases", "scientific_aliases")})


def sound_classes(configured: DataFrame, labels: DataFrame, images: DataFrame) -> DataFrame:
    """Configured classes with the names of their item (qid, locale, label) and an image, the configured one first."""
    one = labels.where("label <> ''").groupBy("qid", T.normalize_locale("locale").alias("locale")).agg(F.min("label").alias("label"))
    names = one.groupBy("qid").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("locale", "label")))).alias("common_names"))
    picture = images.groupBy("qid").agg(F.min("image").alias("_image"))
    d = configured.withColumn("qid", F.col("wikidata_qid")).join(names, "qid", "left").join(picture, "qid", "left")
    return d.withColumn("image_file", F.coalesce(F.nullif("image_file", F.lit("")), "_image")).drop("qid", "_image")
