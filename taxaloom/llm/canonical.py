"""One form for text that looks the same: compatibility forms, invisible characters, look-alikes.

Every Arrow batch is handed to an embedded DuckDB, whose SQL maps the text with nfc_normalize,
translate and regular expressions (`form_sql`). Nothing else leaves the JVM, and the embedded
database is limited to one thread and a small memory so that it fits beside an executor.

What is mapped: all compatibility forms of Unicode (full-width, half-width and mathematical forms, ligatures,
raised and squared characters) to the plain letters; all space characters to one blank, runs and ends of
blanks trimmed; invisible format characters and variation selectors dropped; hyphens that look alike to '-';
combining accents composed; Cyrillic, Greek, Armenian and Cherokee letters to the Latin letters they look like.
The form is a key for comparison alone, not for display, as it also maps letters of genuine Cyrillic or Greek
names: it keeps case, accents, punctuation and every difference that can be seen. Text of ASCII characters alone
only has its blanks mapped, and text without any mapped character skips the maps; both come out the same.

Defined results: null stays null; text of invisible characters alone becomes ''; rows repeat.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from taxaloom.llm.common import spread

#: Cyrillic, Greek, Armenian and Cherokee letters and the Latin letters they look like (cf. UTS 39).
LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ѕ": "s", "ј": "j", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "І": "I", "Ѕ": "S", "Ј": "J",
    "У": "Y", "Ү": "Y", "Ԍ": "G", "Ԛ": "Q", "Ԝ": "W", "ё": "ë", "Ё": "Ë", "ї": "ï", "Ї": "Ï", "ѐ": "è", "Ѐ": "È", "ӓ": "ä", "Ӓ": "Ä", "ӧ": "ö", "Ӧ": "Ö",
    "ҫ": "ç", "Ҫ": "Ç", "ӕ": "æ", "Ӕ": "Æ", "ӱ": "ÿ", "ӑ": "ă", "Ӑ": "Ă", "ӗ": "ĕ", "Ӗ": "Ĕ", "ʼ": "’",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "ο": "o", "ν": "v", "ι": "i", "α": "a", "ρ": "p", "γ": "y", "κ": "k", "χ": "x", "ό": "ó", "ί": "í", "ά": "á", "ϊ": "ï", "ϳ": "j", "ϲ": "c", "Ϲ": "C", "ɑ": "a", "ɡ": "g", "ı": "i",
    "օ": "o", "ո": "n", "ս": "u", "հ": "h", "յ": "j", "ց": "g", "զ": "q", "Օ": "O", "Տ": "S", "Լ": "L", "Ս": "U",
    "Ꭰ": "D", "Ꭱ": "R", "Ꭲ": "T", "Ꭵ": "i", "Ꭺ": "A", "Ꭻ": "J", "Ꭼ": "E", "Ꮃ": "W", "Ꮇ": "M", "Ꮋ": "H", "Ꮍ": "Y", "Ꮐ": "G", "Ꮓ": "Z", "Ꮩ": "V", "Ꮪ": "S", "Ꮮ": "L", "Ꮯ": "C", "Ꮲ": "P", "Ꮶ": "K", "Ᏼ": "B",
    "‐": "-", "‑": "-", "﹣": "-", "－": "-",
}

_INVISIBLE = r"[\p{Cf}\x{034F}\x{115F}\x{1160}\x{17B4}\x{17B5}\x{180B}-\x{180F}\x{3164}\x{FE00}-\x{FE0F}\x{E0100}-\x{E01EF}]"


@cache
def _compatible() -> tuple[dict[str, str], dict[str, str]]:
    """All characters with a compatibility form, by the rule of NFKC: those of one character, and longer ones.

    Spaces are left to the pattern for blanks, invisible characters to theirs; half-width voice marks combine.
    """
    one, more = {"ﾞ": "゙", "ﾟ": "゚"}, {}
    for o in range(0xA0, 0x30000):
        c = chr(o)
        if 0xD800 <= o < 0xE000 or c in one or unicodedata.category(c)[0] in "ZC":
            continue
        k = unicodedata.normalize("NFKC", c)
        if k != c and k != unicodedata.normalize("NFC", c):
            if len(k) == 1:
                one[c] = k
            elif k.strip():
                more[c] = k
    return one, more


def compatibility() -> dict[str, str]:
    """One-character compatibility forms."""
    return _compatible()[0]


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _class(characters: Iterable[str]) -> str:
    """A pattern for any of some characters, as ranges."""
    codes = sorted(map(ord, characters))
    runs: list[list[int]] = []
    for o in codes:
        if runs and o == runs[-1][1] + 1:
            runs[-1][1] = o
        else:
            runs.append([o, o])
    return "[" + "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in runs) + "]"


def form_sql(column: str) -> str:
    """The embedded SQL that takes a text column to its common form."""
    one, more = _compatible()
    same = {**{k: LOOKALIKES.get(v, v) for k, v in one.items()}, **LOOKALIKES}
    longer = {k: "".join(same.get(c, c) for c in v) for k, v in more.items()}
    visible = f"regexp_replace({column}, {_quoted(_INVISIBLE)}, '', 'g')"
    blanks = lambda x: rf"trim(regexp_replace({x}, '[\p{{Z}}\s]+', ' ', 'g'))"
    table = f"map([{', '.join(map(_quoted, longer))}], [{', '.join(map(_quoted, longer.values()))}])"
    spelled = f"case when regexp_matches({visible}, {_quoted(_class(longer))}) then array_to_string([coalesce({table}[c], c) for c in string_split({visible}, '')], '') else {visible} end"
    mapped = f"translate(nfc_normalize({spelled}), {_quoted(''.join(same))}, {_quoted(''.join(same.values()))})"
    return f"""case when strlen({column}) = length({column}) then {blanks(column)}
        when regexp_matches({column}, {_quoted(_class([*same, *longer]))}) then nfc_normalize({blanks(mapped)})
        else nfc_normalize({blanks(visible)}) end"""


def with_form(df: DataFrame, text: str, to: str = "form") -> DataFrame:
    """Add the common form of a text column (in place of one of that name); other columns pass through untouched."""
    df = df.drop(to)
    schema = StructType([*df.schema.fields, StructField(to, StringType())])
    sql = f'select *, {form_sql(_ident(text))} as {_ident(to)} from batch'

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        con = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "256MB"})
        for b in batches:
            con.register("batch", pa.Table.from_batches([b]))
            got = con.sql(sql).to_arrow_table()
            con.unregister("batch")
            yield from got.cast(pa.schema([*b.schema, pa.field(to, pa.string())])).combine_chunks().to_batches()

    return spread(df).mapInArrow(run, schema)


def _ident(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _mixed(names: DataFrame, key: str, text: str, within: tuple[str, ...], materialise) -> DataFrame:
    """Rows of the groups of one look that have more than one spelling, with their form."""
    d = with_form(names.select(key, *within, text).where(F.col(text).isNotNull()), text, "_form").where("_form <> ''")
    if materialise:
        d = materialise(d)
    by = [*within, "_form"]
    mixed = d.groupBy(*by).agg(F.min(text).alias("_lo"), F.max(text).alias("_hi"), F.min(key).alias("_class")).where("_lo <> _hi").select(*by, "_class")
    return d.join(mixed, by)


def same_look_classes(names: DataFrame, key: str = "key", text: str = "name", within: tuple[str, ...] = ("scientific_name", "locale"), materialise=None) -> DataFrame:
    """(class_id, key, spelling): one row for each name that looks like another one of its group but is spelled otherwise.

    class_id is the least key of the class. Exact copies of a spelling stay rows of the class; nothing is expanded into pairs.
    """
    return _mixed(names, key, text, within, materialise).select(F.col("_class").alias("class_id"), key, F.col(text).alias("spelling"))


def same_look_pairs(names: DataFrame, key: str = "key", text: str = "name", within: tuple[str, ...] = ("scientific_name", "locale"), materialise=None) -> DataFrame:
    """(key_a, key_b) of names within the same group that look the same and differ in characters.

    Groups of a look with one spelling, which is nearly all, are dropped after a pre-aggregated
    minimum and maximum; only the rest is joined with itself, on group and form, where adaptive
    execution splits a group that holds a large share of the rows. `materialise` cuts the lineage
    so that the texts are normalised once. Null keys of a group and empty forms pair with nothing.
    """
    by = [*within, "_form"]
    d = _mixed(names, key, text, within, materialise).drop("_class")
    a, b = d.withColumnsRenamed({key: "key_a", text: "_a"}), d.withColumnsRenamed({key: "key_b", text: "_b"})
    return a.join(b, by).where("key_a < key_b and _a <> _b").select("key_a", "key_b").distinct()
