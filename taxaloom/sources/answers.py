"""Answers of taxonomic services to rows: projections over their JSON, all in the JVM.

The input is a column of answer texts as a paged source or a landed cache gives them; broken or
missing answers give null rows or empty arrays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaloom.functions import maps
from taxaloom.functions import text as T

_NAME = "struct<name:string,locale:string,lexicon:string,is_valid:boolean>"
_PHOTO = "struct<url:string,medium_url:string,square_url:string,attribution:string,license_code:string>"
TAXON = f"struct<id:bigint,name:string,iconic_taxon_name:string,preferred_common_name:string,wikipedia_url:string,observations_count:bigint,extinct:boolean,names:array<{_NAME}>,default_photo:{_PHOTO}>"
#: Lexicons that hold codes or scientific names, no common names.
NO_COMMON_LEXICON = ("scientific-names", "aou-4-letter-codes", "aou-6-letter-codes")


def photo_url(p: Column) -> Column:
    """The first address of a photo, in its large size."""
    first = F.coalesce(*[F.nullif(p[k], F.lit("")) for k in ("url", "medium_url", "square_url")])
    return F.coalesce(F.regexp_replace(first, r"/(?:square|small|thumb|medium)\.(\w+)", "/large.$1"), F.lit(""))


def first_names(names: Column) -> Column:
    """Locale to the first valid common name in it."""
    good = F.filter(F.coalesce(names, F.array().cast(f"array<{_NAME}>")), lambda n: F.coalesce(n["is_valid"], F.lit(False)) & (F.coalesce(n["locale"], F.lit("")) != "") & ~n["locale"].isin("sci", "und") & ~F.coalesce(n["lexicon"], F.lit("")).isin(*NO_COMMON_LEXICON))
    keys = F.array_distinct(F.transform(good, lambda n: n["locale"]))
    return F.map_from_arrays(keys, F.transform(keys, lambda k: F.coalesce(F.get(F.filter(good, lambda n: n["locale"] == k), F.lit(0))["name"], F.lit(""))))


def taxon(answer, group, sound_count) -> Column:
    """A taxon's answer as the struct of the first source's record."""
    r = F.from_json(T.col(answer), TAXON)
    p = r["default_photo"]
    blank = lambda c: F.coalesce(c, F.lit(""))
    return F.struct(
        r["id"].alias("inat_id"), T.col(group).alias("taxon_group"), blank(r["iconic_taxon_name"]).alias("iconic_taxon_name"), first_names(r["names"]).alias("common_names"),
        blank(r["wikipedia_url"]).alias("wikipedia_url"), photo_url(p).alias("image_url"), blank(p["attribution"]).alias("image_attribution"), blank(p["license_code"]).alias("image_license"),
        F.coalesce(r["observations_count"], F.lit(0)).alias("observations_count"), T.col(sound_count).alias("sound_observations_count"),
        blank(r["preferred_common_name"]).alias("preferred_common_name"), F.coalesce(r["extinct"], F.lit(False)).alias("extinct"),
    )


def first_licensed_photo(answer) -> Column:
    """struct(url, attribution, license) of the first photo with a free licence, null without one."""
    r = F.from_json(T.col(answer), f"struct<results:array<struct<photos:array<{_PHOTO}>>>>")["results"]
    photos = F.flatten(F.transform(r, lambda o: F.coalesce(o["photos"], F.array().cast(f"array<{_PHOTO}>"))))
    p = F.get(F.filter(photos, lambda x: F.coalesce(x["license_code"].isin(*T.LICENCES), F.lit(False))), F.lit(0))
    return F.when(p.isNotNull(), F.struct(photo_url(p).alias("url"), p["attribution"].alias("attribution"), p["license_code"].alias("license")))


def synonyms(match, listed, name) -> Column:
    """Other names of a species: the accepted one, then its synonyms, binomials only, whatever case."""
    accepted = F.from_json(T.col(match), "struct<species:string>")["species"]
    rows = F.from_json(T.col(listed), "struct<results:array<struct<species:string,canonicalName:string>>>")["results"]
    others = F.filter(F.transform(rows, lambda x: F.coalesce(F.nullif(x["species"], F.lit("")), x["canonicalName"])), lambda n: T.is_binomial(n))
    every = F.concat(F.array(accepted), F.coalesce(others, F.array().cast("array<string>")))
    return F.filter(maps.ordered_distinct(every), lambda n: F.lower(n) != F.lower(T.strip(name)))


def species_code(answer, name) -> Column:
    """Code of the first species-rank entry ("code,rank") whose display name holds the scientific name."""
    rows = F.from_json(T.col(answer), "array<struct<code:string,name:string>>")
    hit = F.filter(rows, lambda x: (F.size(F.split(x["code"], ",")) == 2) & (F.split_part(x["code"], F.lit(","), F.lit(2)) == "species") & F.contains(F.lower(x["name"]), F.lower(T.col(name))))
    return F.split_part(F.get(hit, F.lit(0))["code"], F.lit(","), F.lit(1))


def recording_name(answer, epithet=None) -> Column:
    """Genus and epithet of the first recording (of the given epithet)."""
    rows = F.from_json(T.col(answer), "struct<recordings:array<struct<gen:string,sp:string>>>")["recordings"]
    ok = lambda x: (F.coalesce(T.strip(x["gen"]), F.lit("")) != "") & (F.coalesce(T.strip(x["sp"]), F.lit("")) != "") & ((T.strip(x["sp"]) == T.col(epithet)) if epithet is not None else F.lit(True))
    r = F.get(F.filter(rows, ok), F.lit(0))
    return F.when(r.isNotNull(), F.concat_ws(" ", T.strip(r["gen"]), T.strip(r["sp"])))


def code_page(html) -> Column:
    """struct(description, image_url, ml_asset_id, image_attribution) of a species page's tags."""
    image = F.coalesce(T.meta_tag(html, "image"), F.lit(""))
    return F.struct(
        T.meta_tag(html, "description").alias("description"), F.regexp_replace(image, r"(/asset/\d+).*$", "$1").alias("image_url"),
        F.coalesce(T.asset_id(image), F.lit("")).alias("ml_asset_id"), F.coalesce(T.meta_tag(html, "image:alt"), F.lit("")).alias("image_attribution"),
    )


def sound_classes(df: DataFrame) -> DataFrame:
    """Sound classes as taxonomy rows: clean names only, locales normalised, English filled from the name."""
    own = T.strip(F.coalesce(F.nullif("scientific_name", F.lit("")), F.lit("")))
    common = F.when(T.is_clean_common_name("common_name"), T.strip("common_name")).otherwise(own)
    clean = F.map_filter(maps._safe("common_names"), lambda k, v: T.is_clean_common_name(v))
    local = F.transform_keys(clean, lambda k, v: T.normalize_locale(k))
    d = df.where(T.is_clean_common_name("scientific_name"))
    return d.select(
        "ord", own.alias("scientific_name"), common.alias("common_name"), F.coalesce("taxon_group", F.lit("")).alias("taxon_group"), F.lit("sound_class").alias("record_type"),
        maps.fill(local, F.create_map(F.lit("en"), own)).alias("common_names"), maps.ordered_distinct_ci("common_name_aliases", T.is_clean_common_name).alias("common_name_aliases"),
        maps.ordered_distinct_ci("scientific_name_aliases", T.is_clean_common_name).alias("scientific_name_aliases"), F.coalesce("image_url", F.lit("")).alias("image_url"), F.coalesce("wikidata_qid", F.lit("")).alias("wikidata_qid"),
    )


def bindings(answer, names: list[str]) -> Column:
    """Rows of a query service's answer: an array of structs of the named variables' values, and `lang` of the label."""
    value = "struct<value:string,`xml:lang`:string>"
    fields = ",".join(f"`{n}`:{value}" for n in names)
    rows = F.from_json(T.col(answer), f"struct<results:struct<bindings:array<struct<{fields}>>>>")["results"]["bindings"]
    lang = (lambda r: r["label"]["xml:lang"]) if "label" in names else (lambda r: F.lit(None).cast("string"))
    return F.transform(F.coalesce(rows, F.array().cast(f"array<struct<{fields}>>")), lambda r: F.struct(*[r[n]["value"].alias(n) for n in names], lang(r).alias("lang")))


def page_tables(df: DataFrame, answer: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(normalized, redirects, pages) of answers about titles, as `resolve.follow_titles` takes them.

    pages has title, page_id, extract and the addresses of other languages by locale; continued answers of a page are merged,
    the first extract counting. Pages that are missing are left out.
    """
    step = "array<struct<`from`:string,`to`:string>>"
    page = "struct<pageid:bigint,title:string,missing:string,extract:string,langlinks:array<struct<lang:string,url:string>>>"
    q = df.withColumn("_i", F.monotonically_increasing_id()).select("_i", F.from_json(answer, f"struct<query:struct<normalized:{step},redirects:{step},pages:map<string,{page}>>>")["query"].alias("q"))
    steps = [q.select(F.inline(F.col(f"q.{k}"))).where("`from` is not null").groupBy("from").agg(F.min("to").alias("to")) for k in ("normalized", "redirects")]
    p = q.select("_i", F.explode("q.pages").alias("k", "p")).select("_i", "p.*").where("title is not null and missing is null")
    links = p.select("title", F.explode("langlinks").alias("l")).groupBy("title", "l.lang").agg(F.min("l.url").alias("url"))
    links = links.groupBy("title").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("lang", "url")))).alias("urls"))
    pages = p.groupBy("title").agg(F.min("pageid").alias("page_id"), F.min_by("extract", F.when(F.col("extract") != "", F.col("_i"))).alias("extract"))
    return steps[0], steps[1], pages.join(links, "title", "left")


def file_licences(df: DataFrame, answer: str) -> DataFrame:
    """(file, url, attribution, license, license_url) of the media files that an answer gives a free licence."""
    meta = "struct<LicenseShortName:struct<value:string>,LicenseUrl:struct<value:string>,Artist:struct<value:string>>"
    pages = F.from_json(answer, f"struct<query:struct<pages:map<string,struct<title:string,imageinfo:array<struct<extmetadata:{meta}>>>>>>")["query"]["pages"]
    d = df.select(F.explode(pages).alias("k", "p")).where("p.title like 'File:%' and size(p.imageinfo) > 0").select(F.substring("p.title", 6, 100_000).alias("file"), F.col("p.imageinfo")[0]["extmetadata"].alias("m"))
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    d = d.select("file", blank("m.LicenseShortName.value").alias("license"), blank("m.LicenseUrl.value").alias("license_url"), T.strip(T.strip_tags(blank("m.Artist.value"))).alias("attribution")).where(T.is_free_licence("license"))
    one = d.groupBy(F.replace("file", F.lit(" "), F.lit("_")).alias("file")).agg(F.min(F.struct("attribution", "license", "license_url")).alias("v"))
    return one.select("file", T.commons_url("file").alias("url"), "v.*")


def taxonomy_names(csv_text) -> Column:
    """(code, name) entries of a taxonomy list as the service delivers it: CSV text with SPECIES_CODE and COMMON_NAME."""
    lines = F.filter(F.split(T.col(csv_text), r"\r?\n"), lambda x: x != "")
    cells = lambda line: F.transform(F.split(line, r',(?=(?:[^"]*"[^"]*")*[^"]*$)'), lambda c: F.regexp_replace(F.regexp_replace(c, r'^"|"$', ""), '""', '"'))
    head = cells(F.get(lines, F.lit(0)))
    at = lambda row, name: F.get(row, F.array_position(head, name).cast("int") - 1)
    rows = F.transform(F.slice(lines, F.lit(2), F.greatest(F.size(lines), F.lit(1))), cells)
    return F.filter(F.transform(rows, lambda r: F.struct(at(r, "SPECIES_CODE").alias("code"), at(r, "COMMON_NAME").alias("name"))), lambda e: F.coalesce(e["code"], F.lit("")) != "")


def first_title(answer) -> Column:
    """The best title of a page search, null for none."""
    return F.get(F.from_json(T.col(answer), "struct<query:struct<search:array<struct<title:string>>>>")["query"]["search"], F.lit(0))["title"]


def item_labels(df: DataFrame, answer: str) -> tuple[DataFrame, DataFrame]:
    """((qid, locale, label), (qid, image)) of items: the first label of a locale and the first image's file name."""
    r = df.select(F.inline(bindings(answer, ["item", "label", "image"]))).withColumn("qid", F.substring_index("item", "/", -1))
    labels = r.where("label <> '' and lang <> ''").groupBy("qid", T.normalize_locale("lang").alias("locale")).agg(F.min("label").alias("label"))
    images = r.where("image <> ''").groupBy("qid").agg(F.min(F.try_url_decode(F.substring_index("image", "/", -1))).alias("image"))
    return labels, images
