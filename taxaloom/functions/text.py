"""Text expressions. Everything here is a Column builder evaluated in the JVM, but for `udf.py`."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Patterns that decide results and must agree with the source data's conventions.
BINOMIAL = r"^[A-Z][A-Za-z.\-]+ [a-z][A-Za-z.\-]+$"
BAD_NAME_CHARS = r"[()\[\]{}/\\<>|]"
WORD_TOKEN = r"[\p{L}\p{N}_](?:[\p{L}\p{N}_'\-]*[\p{L}\p{N}_])?"
CJK_CHAR = r"[\x{3400}-\x{4dbf}\x{4e00}-\x{9fff}\x{3040}-\x{30ff}\x{ac00}-\x{d7af}]"
LICENCES = ("cc0", "cc-by", "cc-by-sa", "cc-by-nd", "cc-by-nc", "cc-by-nc-sa", "cc-by-nc-nd", "pd", "gfdl")


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Take away white space of any kind at both ends (trim() knows only the blank)."""
    return F.regexp_replace(col(c), r"(?U)^\s+|\s+$", "")


def blank_to_null(c) -> Column:
    return F.nullif(strip(c), F.lit(""))


def null_to_blank(c) -> Column:
    return F.coalesce(col(c), F.lit(""))


def normalize_space(c) -> Column:
    return strip(F.regexp_replace(null_to_blank(c), r"(?U)\s+", " "))


def word_count(c) -> Column:
    """Word tokens plus CJK characters; null counts as empty."""
    t = null_to_blank(c)
    return (F.regexp_count(t, F.lit(WORD_TOKEN)) + F.regexp_count(t, F.lit(CJK_CHAR))).cast("bigint")


def is_binomial(c) -> Column:
    """Genus and epithet only; null is false."""
    return F.coalesce(strip(c).rlike(BINOMIAL), F.lit(False))


def is_clean_scientific_name(c) -> Column:
    return is_binomial(c) & ~null_to_blank(c).rlike(BAD_NAME_CHARS)


def is_clean_common_name(c) -> Column:
    """Not empty, no bracket, slash or pipe, no run of white space inside."""
    t = strip(null_to_blank(c))
    return (t != "") & ~t.rlike(BAD_NAME_CHARS) & ~t.rlike(r"(?U)\s{2,}")


def contains_any_name(text, names) -> Column:
    """Whether a text holds one of the names (an array) as whole words, whatever the case."""
    hay = F.lower(normalize_space(text))

    def hit(n: Column) -> Column:
        clean = F.lower(normalize_space(n))
        quoted = F.concat(F.lit(r"(?U)\b\Q"), clean, F.lit(r"\E\b"))
        return (clean != "") & F.regexp_like(hay, quoted)

    return F.coalesce(F.exists(col(names), hit), F.lit(False))


def strip_tags(c) -> Column:
    return F.regexp_replace(col(c), r"<[^>]+>", "")


def meta_tag(html, name: str) -> Column:
    """Content of an Open Graph tag, in either order of its attributes; null without one."""
    a = rf"""(?is)<meta[^>]+property=["']og:{name}["'][^>]+content=["']([^"']*)["']"""
    b = rf"""(?is)<meta[^>]+content=["']([^"']*)["'][^>]+property=["']og:{name}["']"""
    return F.coalesce(*[F.nullif(F.regexp_extract(col(html), p, 1), F.lit("")) for p in (a, b)])


def asset_id(url) -> Column:
    return F.nullif(F.regexp_extract(col(url), r"/asset/(\d+)", 1), F.lit(""))


def asset_url(url, size: int = 1800) -> Column:
    """Put another size behind an asset address that ends in one."""
    return F.regexp_replace(col(url), r"(/asset/\d+)(?:/\d+)?/?$", f"$1/{size}")


def code_variants(code) -> Column:
    """A code, then (for a version of 2 or more) its version 1, then the base without a version."""
    c = col(code)
    base = F.nullif(F.regexp_extract(c, r"^([a-z]+?)(\d+)$", 1), F.lit(""))
    version = F.try_to_number(F.nullif(F.regexp_extract(c, r"^([a-z]+?)(\d+)$", 2), F.lit("")), F.lit("999999999")).cast("int")
    one = F.when(version >= 2, F.concat(base, F.lit("1")))
    return F.array_compact(F.array(c, one, F.when(version.isNotNull(), base)))


def url_quote(c) -> Column:
    """Percent-encode everything but letters, digits and _.-~ (blank as %20)."""
    x = F.url_encode(col(c))
    for a, b in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        x = F.replace(x, F.lit(a), F.lit(b))
    return x


def page_title(url) -> Column:
    """The title behind /wiki/ in an address, decoded, blanks for underscores; null for other addresses."""
    raw = F.nullif(F.regexp_extract(col(url), r"/wiki/([^?#]+)", 1), F.lit(""))
    return F.replace(F.try_url_decode(raw), F.lit("_"), F.lit(" "))


def page_key(title) -> Column:
    """A title as compared: underscores as blanks, lower case."""
    return F.lower(F.replace(strip(title), F.lit("_"), F.lit(" ")))


def commons_url(file_name, base: str = "https://upload.wikimedia.org/wikipedia/commons") -> Column:
    """Address of a media file: sharded by the first digits of the name's md5."""
    n = F.replace(col(file_name), F.lit(" "), F.lit("_"))
    h = F.md5(n)
    return F.concat(F.lit(base + "/"), F.substring(h, 1, 1), F.lit("/"), F.substring(h, 1, 2), F.lit("/"), url_quote(n))


def cache_key(c) -> Column:
    return F.substring(F.sha2(col(c), 256), 1, 16)


def normalize_locale(c) -> Column:
    """Lower case with hyphens; Norwegian Bokmål and Brazilian Portuguese to their language."""
    x = F.lower(F.replace(strip(c), F.lit("_"), F.lit("-")))
    return F.when(x == "nb", "no").when(x == "pt-br", "pt").otherwise(x)


def record_id(number) -> Column:
    """BN and the number in five digits or more."""
    return F.format_string("BN%05d", col(number).cast("bigint"))


def genus(c) -> Column:
    return F.split_part(strip(c), F.lit(" "), F.lit(1))


def epithet(c) -> Column:
    return F.nullif(F.split_part(strip(c), F.lit(" "), F.lit(2)), F.lit(""))


def is_free_licence(c) -> Column:
    """A Commons licence name that permits use: any Creative Commons, public domain or GFDL."""
    x = F.lower(col(c))
    return F.coalesce(x.contains("cc") | x.contains("public domain") | x.contains("pd") | x.contains("gfdl"), F.lit(False))


def age_text(stamp, now) -> Column:
    """Age between two timestamps in the largest whole unit: 3d, 5h, 12m, 40s."""
    s = F.unix_timestamp(col(now)) - F.unix_timestamp(col(stamp))
    whole = lambda k, u: F.concat(F.floor(s / k).cast("string"), F.lit(u))
    return F.when(s >= 86400, whole(86400, "d")).when(s >= 3600, whole(3600, "h")).when(s >= 60, whole(60, "m")).otherwise(whole(1, "s"))


#: How an uploader is named in licence lines, by language.
UPLOADED = (
    r"uploaded\s+by", r"uploadet\s+af", r"subido\s+por", r"carregado\s+por", r"загрузил", r"lähettänyt", r"feltöltötte:", r"によって投稿されました", r"由\s*.+?\s*上传",
)
#: Notices of reserved or unknown rights, by language.
RIGHTS = (
    r"(?:no|some|all)\s+(?:known\s+)?(?:copy)?rights?\s+(?:reserved|restrictions)", r"alcuni\s+diritti\s+riservati", r"certains\s+droits\s+réservés", r"kai\s+kurios\s+teisės\s+saugomos",
    r"visos\s+teisės\s+saugomos", r"nogle\s+rettigheder\s+forbeholdes", r"некоторые\s+права\s+защищены", r"все\s+права\s+защищены",
    r"нет\s+известных\s+ограничений\s+авторского\s+права", r"nėra\s+žinomų\s+autorinių\s+teisių\s+apribojimų", r"保留部分权利", r"no\s+known\s+copyright\s+restrictions",
)
#: Pictographs and joiners dropped from names.
PICTOGRAPHS = r"[\x{1F000}-\x{1FFFF}\x{2600}-\x{27BF}\x{FE00}-\x{FE0F}\x{200D}\x{E0020}-\x{E007F}]+"


def image_author(attribution, source) -> Column:
    """The author in an attribution line, by the habits of its source; '' where there is none."""
    t = strip(null_to_blank(attribution))
    dashed = (col(source) == "ebird") | (F.contains(t, F.lit(" - ")) & ~t.startswith("("))
    licensed = (col(source) == "inat") | t.startswith("(c)")
    after = F.when(F.contains(t, F.lit(" - ")), strip(F.substring(t, F.locate(" - ", t) + 3, F.length(t)))).otherwise(t)
    archived = F.regexp_replace(after, r"(?i)\s*/\s*Macaulay Library.*", "")
    y = F.regexp_replace(t, r"(?i)^\(c\)\s*", "")
    y = F.regexp_replace(F.regexp_replace(y, r"\(CC[^)]*\)", ""), r"（CC[^）]*）", "")
    uploader = F.regexp_extract(y, rf"(?iu),?\s*(?:{'|'.join(UPLOADED)})\s*(.+)", 1)
    y = F.when(uploader != "", uploader).otherwise(y)
    y = F.regexp_replace(y, rf"(?iu),?\s*(?:{'|'.join(RIGHTS)}).*", "")
    x = F.when(F.coalesce(dashed, F.lit(False)), archived).when(F.coalesce(licensed, F.lit(False)), y).otherwise(t)
    x = F.regexp_replace(x, r"\s*[(\[][^)\]]*[)\]]", "")
    x = F.regexp_replace(F.regexp_replace(x, PICTOGRAPHS, ""), r"[<>{}|\\^~`/]", "")
    return F.regexp_replace(F.regexp_replace(x, r"(?U)\s+", " "), r"^[ ,.、，]+|[ ,.、，]+$", "")
