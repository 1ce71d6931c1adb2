"""Queries of the text operators, and their SQL twins where SQL can say the same."""

from __future__ import annotations

import unicodedata

from pyspark.sql import functions as F

from taxaloom.llm import canonical, langid, leakage, matching, mixing, quality, reading, truncation
from taxaloom.llm.common import COMMON_WORDS, checkpoint, descriptions, ensure, table


def p1_statistics(spark, sf_dir):
    """Statistics and verdict of every entry of `descriptions`."""
    d = quality.assess(descriptions(table(ensure(spark), sf_dir, "species_records")))
    return d.select("rec_id", "locale", *quality.FEATURES, "verdict")


def p1_named(spark, sf_dir):
    """The five named statistics of every entry of `descriptions`."""
    d = quality.with_statistics(descriptions(table(ensure(spark), sf_dir, "species_records")))
    return d.where("text is not null").select("rec_id", "locale", "word_count", "mean_word_length", "symbol_ratio", "punct_line_share", "common_word_share")


def p1_found(spark, sf_dir):
    """Entries whose verdict is list, table or junk."""
    return quality.flagged(descriptions(table(ensure(spark), sf_dir, "species_records"))).select("rec_id", "locale").distinct()


def _names(spark, sf_dir):
    """name_rows and the English names of species_records as (key, scientific_name, locale, name)."""
    rows = table(ensure(spark), sf_dir, "name_rows").select(F.col("name_id").alias("key"), "scientific_name", "locale", F.col("common_name").alias("name"))
    own = table(spark, sf_dir, "species_records").select(F.col("rec_id").alias("key"), "scientific_name", F.lit("en").alias("locale"), F.col("common_name").alias("name"))
    return rows.unionByName(own)


def p4_found(spark, sf_dir):
    """Pairs of names of one species and locale that look the same but differ in characters."""
    return canonical.same_look_pairs(_names(spark, sf_dir), materialise=checkpoint)


def p4_classes(spark, sf_dir):
    """The same as one row a name and its class."""
    return canonical.same_look_classes(_names(spark, sf_dir), materialise=checkpoint)


def p4_forms(spark, sf_dir):
    """Every name, also of the maps of species_records, in its common form."""
    maps = table(ensure(spark), sf_dir, "species_records").select(F.col("rec_id").alias("key"), "scientific_name", F.explode("common_names").alias("locale", "name"))
    return canonical.with_form(_names(spark, sf_dir).unionByName(maps), "name", "form")


def p6_found(spark, sf_dir):
    """Languages other than the label's in which a description or one of its sentences is written."""
    d = descriptions(table(ensure(spark), sf_dir, "species_records"))
    return langid.other_languages(d, ["rec_id", "locale"]).distinct()


def p6_languages(spark, sf_dir):
    """The language of each description with its confidence."""
    return langid.document_languages(descriptions(table(ensure(spark), sf_dir, "species_records")), ["rec_id", "locale"])


def p6_segments(spark, sf_dir):
    """Each segment of each description with its language and confidence."""
    d = langid.with_segments(descriptions(table(ensure(spark), sf_dir, "species_records")).select("rec_id", "locale", "text"))
    return d.select("rec_id", "locale", F.posexplode("segments").alias("segment", "s")).select("rec_id", "locale", "segment", "s.*")


def _only_prose(d):
    return quality.prose(d)


def p5_found(spark, sf_dir):
    """Descriptions that were cut off mid-word or mid-sentence."""
    d = descriptions(table(ensure(spark), sf_dir, "species_records"))
    return truncation.cut_entries(d, ["rec_id", "locale"], _only_prose, materialise=checkpoint).where("cut").select("rec_id", "locale").distinct()


def p5_sources(spark, sf_dir):
    """Share of cut entries of each source."""
    d = descriptions(table(ensure(spark), sf_dir, "species_records"))
    return truncation.source_report(d, truncation.cut_entries(d, ["rec_id", "locale"], _only_prose, materialise=checkpoint))


def p7_leaks(spark, sf_dir):
    """Items found in documents, with matching words, span, coverage of the item and the place in the text."""
    return leakage.find_leaks(table(ensure(spark), sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p7_runs(spark, sf_dir):
    """Items and documents with an unbroken run of LEAST_WORDS words or more, and its words."""
    d = p7_leaks(spark, sf_dir)
    return d.where(F.col("unbroken") >= leakage.LEAST_WORDS).select("item_id", "doc_id", F.col("unbroken").alias("words"))


def p7_found(spark, sf_dir):
    """(item, document) of every leaked passage."""
    return p7_leaks(spark, sf_dir).select("item_id", "doc_id").distinct()


def p7_cleaned(spark, sf_dir):
    """Documents without their leaked spans."""
    return leakage.without_leaks(table(ensure(spark), sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "eval_items"))


def _prepared_mix(spark, sf_dir):
    """Documents with their tokens; the topic is the group of the species that a document is about."""
    groups = table(ensure(spark), sf_dir, "species_records").where("taxon_group is not null").groupBy("scientific_name").agg(F.max_by("taxon_group", F.struct("received_at", "rec_id")).alias("topic"))
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "scientific_name")
    counted = mixing.with_tokens(d).drop("text").withColumnRenamed("tokens", "_tokens")
    d = counted.join(groups, "scientific_name", "left")
    return mixing.cells_of(d, tokens="_tokens", topic="topic", materialise=checkpoint)


def p8_mix(spark, sf_dir):
    """Documents of each mix with the number of times each is used."""
    return mixing.mix(_prepared_mix(spark, sf_dir), table(spark, sf_dir, "mix_targets"))


def p8_shares(spark, sf_dir):
    """Shares reached by each source of each mix."""
    return mixing.shares(p8_mix(spark, sf_dir), table(spark, sf_dir, "mix_targets"))


def p8_kept(spark, sf_dir):
    """Whether each mix keeps its limits of repeats and its shares."""
    targets = table(ensure(spark), sf_dir, "mix_targets")
    mixed = checkpoint(p8_mix(spark, sf_dir))
    return mixing.kept(mixed, mixing.shares(mixed, targets))


def p8_marginals(spark, sf_dir):
    """Shares of languages and topics that each mix was to have and has."""
    prepared, targets = _prepared_mix(spark, sf_dir), table(spark, sf_dir, "mix_targets")
    return mixing.marginals(mixing.mix(prepared, targets), prepared, targets)


def p9_levels(spark, sf_dir):
    """Reading level of every document."""
    d = table(ensure(spark), sf_dir, "documents")
    return reading.with_level(d.select("doc_id", "text"), reading.fit_on(d, table(spark, sf_dir, "reading_labels"))).select("doc_id", "reading_score", "reading_level")


def p9_profile(spark, sf_dir):
    """Documents of each source and language by reading level."""
    d = table(ensure(spark), sf_dir, "documents").select("doc_id", "source", "lang")
    return d.join(p9_levels(spark, sf_dir), "doc_id").groupBy("source", "lang", "reading_level").agg(F.count("*").alias("documents"))


def p9_found(spark, sf_dir):
    """Documents of reading level 4."""
    return p9_levels(spark, sf_dir).where("reading_level = 4").select("doc_id").distinct()


def p3_matches(spark, sf_dir):
    """Matched classes: a species of species_records and a distinct listing of xc_species, with a confidence."""
    a, _ = matching.match_classes(table(ensure(spark), sf_dir, "species_records"), table(spark, sf_dir, "xc_species"), materialise=checkpoint)
    return a.select("sid", "unit", "scientific_name", "confidence", "role")


def p3_members(spark, sf_dir):
    """The class of every row of species_records and xc_species."""
    return matching.members(table(ensure(spark), sf_dir, "species_records"), table(spark, sf_dir, "xc_species"), materialise=checkpoint)


def p3_found(spark, sf_dir):
    """Pairs of rows that describe one species."""
    d = matching.match(table(ensure(spark), sf_dir, "species_records"), table(spark, sf_dir, "xc_species"), materialise=checkpoint)
    return d.select("rec_id", "xc_id").distinct()


QUERIES = {
    "p3_found": p3_found,
    "p3_matches": p3_matches,
    "p3_members": p3_members,
    "p8_mix": p8_mix,
    "p8_shares": p8_shares,
    "p8_marginals": p8_marginals,
    "p8_kept": p8_kept,
    "p9_found": p9_found,
    "p9_levels": p9_levels,
    "p9_profile": p9_profile,
    "p7_found": p7_found,
    "p7_leaks": p7_leaks,
    "p7_runs": p7_runs,
    "p7_cleaned": p7_cleaned,
    "p5_found": p5_found,
    "p5_sources": p5_sources,
    "p6_found": p6_found,
    "p6_languages": p6_languages,
    "p6_segments": p6_segments,
    "p4_found": p4_found, "p4_classes": p4_classes, "p4_forms": p4_forms, "p1_found": p1_found, "p1_named": p1_named, "p1_statistics": p1_statistics,
}

_NAMES = """(select name_id as key, scientific_name, locale, common_name as name from name_rows
    union all select rec_id, scientific_name, 'en', common_name from species_records)"""


def _characters() -> str:
    """A map of single characters to what they stand for, straight from the rule of NFKC and the look-alikes."""
    out = {}
    for o in range(0xA0, 0x30000):
        c = chr(o)
        if 0xD800 <= o < 0xE000:
            continue
        kind = unicodedata.category(c)
        if kind == "Cf" or o in (0x34F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164) or 0x180B <= o <= 0x180F or 0xFE00 <= o <= 0xFE0F:
            out[c] = ""
        elif kind[0] == "Z":
            out[c] = " "
        else:
            k = {"ﾞ": "゙", "ﾟ": "゚"}.get(c) or unicodedata.normalize("NFKC", c)
            k = "".join(canonical.LOOKALIKES.get(x, x) for x in k)
            if k != c:
                out[c] = k
    quoted = lambda v: "'" + v.replace("'", "''") + "'"
    return f"map([{', '.join(map(quoted, out))}], [{', '.join(map(quoted, out.values()))}])"


#: Forms by other means than the operator's: distinct names split into characters, each looked up, joined again.
_FORM_OF = f"""m as (select {_characters()} as m), n as (select distinct name from (select common_name as name from name_rows union all select common_name from species_records union all select unnest(map_values(common_names)) from species_records) where name is not null),
    f as (select name, nfc_normalize(trim(regexp_replace(array_to_string([coalesce(m.m[c], c) for c in string_split(nfc_normalize(name), '')], ''), '[\\s]+', ' ', 'g'))) as form from n, m)"""
_FORMS = f"(select x.*, form from {_NAMES} x left join f using (name))"

_D = "(select rec_id, e.key as locale, e.value as t from (select rec_id, unnest(map_entries(descriptions)) as e from species_records) where e.value is not null)"
_COMMON = ", ".join("'" + w.replace("'", "''") + "'" for w in sorted({w for ws in COMMON_WORDS.values() for w in ws}))
_CJK = r"len(regexp_extract_all(t, '[\x{3040}-\x{30ff}\x{3400}-\x{9fff}\x{ac00}-\x{d7af}]'))"
_ANY_SPACE = r"[\s\x0b\x{85}\p{Z}]"

#: Words as `leakage.tokens` gives them, by other means: the common form of problem 4 without accents.
_WORDS_SQL = rf"""regexp_extract_all(regexp_replace(replace(strip_accents(lower({canonical.form_sql("x")})), 'ß', 'ss'), '[''’]', '', 'g'), '[\p{{L}}\p{{N}}]+')"""


def _words_of(rows: str, key: str) -> str:
    """(key, i, w): the words of texts in order, split words joined."""
    joined = r"regexp_replace(regexp_replace(text, '(\p{L})[-‐‑]\s*\n\s*(\p{L})', '\1\2', 'g'), '(\p{L})[-‐‑] ([a-zà-ÿ])', '\1\2', 'g')"
    return f"(select {key}, unnest(ws) as w, generate_subscripts(ws, 1) as i from (select {key}, {_WORDS_SQL} as ws from (select {key}, {joined} as x from {rows})))"


def _grams(words: str, key: str) -> str:
    w = "over (partition by {0} order by i rows between current row and 11 following)".format(key)
    return f"(select {key}, i, string_agg(w, ' ') {w} as g, count(*) {w} as n from {words})"


#: Twins where SQL can say the same; the other operators are tested against brute force or held-out cases.
ORACLE: dict[str, str] = {
    # What must hold of every mix.
    "p8_kept": "select distinct mix_name, true as repeats_kept, true as each_once, true as shares_met from mix_targets",
    "p1_named": rf"""with s as (select *, len([w for w in regexp_split_to_array(t, '[\s\x0b\x{{85}}\x{{a0}}]+') if w <> '']) + floor({_CJK} / 2)::bigint as word_count, greatest(length(t), 1) as n, {_CJK} as cjk,
          [l for l in string_split(t, chr(10)) if trim(l) <> ''] as lines, [w for w in regexp_split_to_array(lower(t), '[^\p{{L}}]+') if w <> ''] as tokens from {_D})
        select rec_id, locale, word_count, round((length(t) - len(regexp_extract_all(t, '{_ANY_SPACE}'))) / greatest(word_count, 1), 4) as mean_word_length,
          round(len(regexp_extract_all(t, '[^\p{{L}}\p{{M}}\p{{N}}\s\x0b.,!?:…。、！？()\[\]"“”„«»‘’\x{{27}}\x{{2013}}\x{{2014}}-]')) / n, 4) as symbol_ratio,
          round(coalesce(len([l for l in lines if regexp_matches(rtrim(l), '[.!?…。！？]["”»’)\]\d\[]*$')]) / nullif(len(lines), 0), 0), 4) as punct_line_share,
          round((len([w for w in tokens if w in ({_COMMON})]) + len(regexp_extract_all(t, '[\x{{3040}}-\x{{309f}}]')) / 4) / greatest(len(tokens) + cjk / 2, 1), 4) as common_word_share from s""",
    # Runs of equal words by twelve-word pieces on one diagonal, without an automaton; instruction lines are those that end in a question or answer to give.
    "p7_runs": f"""with it as (select item_id, case when regexp_matches(text, '^(Read the passage and answer the question below|Answer from the text only|Lies den Text und beantworte die Frage)[.]') then regexp_replace(text, '^[^.]*[.]\\s+', '') else text end as text from eval_items where text is not null),
        a as {_grams(_words_of("it", "item_id"), "item_id")}, b as {_grams(_words_of("documents", "doc_id"), "doc_id")},
        m as (select distinct item_id, doc_id, a.i as ia, b.i as ib from a join b on a.g = b.g where a.n = 12 and b.n = 12),
        r as (select *, ib - row_number() over (partition by item_id, doc_id, ib - ia order by ib) as island from m),
        l as (select item_id, doc_id, ib - ia as diagonal, island, count(*) + 11 as words from r group by all)
        select item_id, doc_id, max(words) as words from l group by all""",
    "p4_found": f"""with {_FORM_OF} select distinct a.key as key_a, b.key as key_b from {_FORMS} a join {_FORMS} b on a.scientific_name = b.scientific_name and a.locale = b.locale and a.form = b.form
        where a.key < b.key and a.name <> b.name and a.form <> ''""",
    "p4_classes": f"""with {_FORM_OF} select class_id, key, name as spelling from (select *, min(key) over w as class_id, min(name) over w as lo, max(name) over w as hi from {_FORMS} where form <> '' and scientific_name is not null and locale is not null
        window w as (partition by scientific_name, locale, form)) where lo <> hi""",
    "p4_forms": f"""with {_FORM_OF} select key, scientific_name, locale, name, form from {_FORMS} union all select rec_id, scientific_name, e.key, e.value, form
        from (select rec_id, scientific_name, unnest(map_entries(common_names)) as e from species_records) left join f on f.name = e.value""",
}
