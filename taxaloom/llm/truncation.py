"""Texts cut off at a field limit or in transfer, and how often each source cuts.

Each text runs through a stack automaton: brackets, quotes and markup tags push and pop. What is
left open at the end, a broken escape, entity or multibyte sequence, a broken word at a hyphen and a mark put at
a cut (ellipsis, "read more") prove a cut. A missing terminator proves nothing by itself; it is held
against the baselines of its source:

* the share of the source's texts of that kind (one segment, or more) that have a terminator: where
  single segments mostly have none, as in lists of short phrases, a missing one says nothing;
* the lengths of its terminated texts: where texts without one pile up beyond what these predict, lies
  a field limit;
* the share of its unterminated texts that are complete all the same. It is estimated for each
  source by expectation and maximisation over how often closed sentences end in the last words of
  each text, of all times these words occur; a text is cut where cutting is the likelier cause.

The estimates are smoothed and have no thresholds in counts, so that sizes of tables don't matter. Word counts
are pre-aggregated in Python per batch, summed by key in one shuffle and joined to the suspects by key;
a source's estimate runs over a histogram of fixed size. Nothing is collected or broadcast.

Defined results: null, empty and blank texts are complete; a text ending in white space is judged
by what stands before it; repeated rows give repeated results; a text without a source has the
source '' in the report.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Brackets and quotes that pair.
PAIRS = {")": "(", "]": "[", "}": "{", "”": "“", "»": "«", "」": "「", "』": "『", "）": "（"}
_OPEN = set(PAIRS.values())
_TOKEN = re.compile(r"[()\[\]{}“”„«»「」『』（）\"]|<(?:/?[A-Za-z][^<>]*>|/?[A-Za-z]?[^<>\s]*$)")
_ENDS = frozenset(".!?。！？")
_AFTER = frozenset("\"”»’“')]）」』")
_MARK = re.compile(
    r"\s*(?:[(\[<]?\s*(?:…|\.{3,})\s*[)\]>]?|[(\[]\s*(?:\.{2,}|…)?\s*(?:read\s+(?:more|on)|more|continued|cont\.|mehr|weiterlesen|lire\s+la\s+suite|suite|leer\s+m[áa]s|sigue|ver\s+mais|leia\s+mais|continua|lees\s+meer|l[äa]s\s+mer|czytaj\s+dalej|далее|続きを読む|続き)?\s*(?:…|\.{3})?\s*[)\]]?"
    r"|[\s–—-]*(?:read more|continue reading|weiterlesen|lire la suite|leer más|ver mais|leggi tutto|lees meer|läs mer|czytaj więcej|читать далее|続きを読む)\W*)$",
    re.I,
)
_BROKEN = re.compile(r"(?:&(?:[A-Za-z]{1,8}|#\d{0,5}|#x[0-9A-Fa-f]{0,4})(?:;(?:[A-Za-z]{1,6}|#\d*)?)?|&|\\u[0-9A-Fa-f]{0,3}|\\x[0-9A-Fa-f]?|\\|%[0-9A-Fa-f]?|(?:%[0-9A-Fa-f]{2})+|�+|[\ud800-\udfff]|[ÃÂÐÑ])$")
_ENTITY_WHOLE = re.compile(r"&(?:[A-Za-z]{2,8}|#\d{2,5}|#x[0-9A-Fa-f]{2,4});$")
#: Characters other than white space that the longest mark or broken sequence can take.
_LONGEST = 80
#: Words that a sentence has on average; the share of cuts that go through a word; how much likelier a cut is
#: than an end where the last word stands nowhere else.
SENTENCE, THROUGH_WORD, UNKNOWN = 16, 0.5, 4
#: Weight of the wider context in the estimate of a narrower one.
SMOOTHING = 2
#: Texts by which the share of all of a source's texts counts in that of its single segments.
BORROWED = 4
#: Share of single segments with a terminator from which on a source's missing ones count.
REGULAR = 0.75
_END = re.compile(r"(?<=[.!?…])[\"”»’)\]]*(?:\s*\[\d+\])*\s+|(?<=[。！？])(?:\[\d+\])*\s*|\n\s*\n|\n(?=\s*(?:[-*•·–]|\(?\d{1,3}[.)])\s)")
_WORD = re.compile(r"[぀-ヿ一-鿿々ー]|[^\W_]+(?:['’-][^\W_]+)*")
_SHORT = re.compile(r"(?:\b[^\W\d_]{1,4}|\d)\.$")


def automaton(text: str) -> list[str]:
    """What is left on the stack after the text: open brackets, quotes and tags, innermost last."""
    stack: list[str] = []
    for m in _TOKEN.finditer(text):
        x = m.group()
        if x == "„":
            stack.append("“de")
        elif x == "“" and stack and stack[-1] == "“de":
            stack.pop()
        elif x in _OPEN:
            stack.append(x)
        elif x in PAIRS:
            if stack and (stack[-1] == PAIRS[x] or x == "”" and stack[-1] == "“de"):
                stack.pop()
        elif x == '"':
            stack.pop() if stack and stack[-1] == '"' else stack.append('"')
        elif x.startswith("<"):
            if not x.endswith(">"):
                stack.append("<")
            elif x.startswith("</"):
                if stack and stack[-1].startswith("<"):
                    stack.pop()
            elif not x.endswith("/>") and not re.match(r"<(?:br|hr|img|p|li)\b", x, re.I):
                stack.append("<tag>")
    return stack


def _masked(w: str) -> str:
    return "0" if w[0].isdigit() else "^" if w[0].isupper() else w


def _keys(words: list[str]) -> list[str]:
    """Context keys of the last of `words`: masked two, the last one."""
    last = words[-1]
    return ["2 " + " ".join(map(_masked, words[-2:])), "1 " + ("0" if last[0].isdigit() else last.lower())]


def _sentences(text: str) -> list[str]:
    return [s for s in _END.split(text) if s and s.strip()]


def terminated(text: str) -> bool:
    """Whether a text ends in a terminator, quotes, brackets and reference marks after it aside."""
    n = len(text)
    while n:
        c = text[n - 1]
        if c == "]" and text[(at := text.rfind("[", 0, n)) + 1 : n - 1].isdigit() and at >= 0:
            n = at
        elif c in _AFTER or c.isspace():
            n -= 1
        else:
            return c in _ENDS
    return False


def _tail(text: str) -> int:
    """Where the part begins in which a mark or broken sequence at the end must lie, however long its blanks."""
    at, left = len(text), _LONGEST
    while at and left:
        at -= 1
        left -= not text[at].isspace()
    return at


def analyse(text: str | None) -> dict:
    """The automaton's findings and, of an unterminated text, the keys of its end."""
    body = (text or "").rstrip()
    out = {"closed": True, "marked": False, "broken": False, "open": False, "size": len(body), "single": True, "hanging": False, "keys": []}
    if not body:
        return out
    at = _tail(body)
    mark = _MARK.search(body, at)
    marked = mark is not None and mark.group().strip() != "" and mark.start() > 0
    core = body[: mark.start()].rstrip() if marked else body
    hit = _BROKEN.search(core, min(at, len(core)))
    broken = hit is not None and not _ENTITY_WHOLE.search(core, min(at, len(core))) and (hit.group() not in ("%",) or not core[-2:-1].isdigit())
    if broken:
        core = core[: hit.start()].rstrip()
    stack = automaton(core)
    if stack and stack[-1] == "<":
        broken, core = True, re.sub(r"<[^<>]*$", "", core).rstrip()
    elif core.endswith(("(", "[", "“", "«", "„", "<")):
        broken, core = True, core[:-1].rstrip()
    hyphen = core.endswith(("-", "‐")) and core[-2:-1].isalpha()
    closed = terminated(core) and not hyphen
    # Within a bracket, the point of an abbreviation or a number is no terminator.
    if closed and stack and _SHORT.search(core):
        closed = False
    inner = _END.search(core)
    out |= {"closed": closed, "marked": marked, "broken": broken or hyphen, "open": bool(stack) and not closed, "size": len(text or ""), "single": inner is None or not any(map(str.isalpha, core[inner.end() :]))}
    if not closed:
        parts = _sentences(core)
        words = _WORD.findall(parts[-1]) if parts else []
        out |= {"hanging": bool(re.search(r"[,;:、，–—&/]$", core)), "keys": _keys(words) if words else []}
    return out


def count_contexts(texts: list[str | None]) -> tuple[Counter, Counter]:
    """How often each context key is seen, and how often at the end of a closed sentence."""
    seen: Counter = Counter()
    ended: Counter = Counter()
    for t in texts:
        if not t:
            continue
        keys: list[str] = []
        for s in _sentences(t.rstrip()):
            words = _WORD.findall(s)
            if not words:
                continue
            mask = [_masked(w) for w in words]
            two = ["2 " + mask[0], *map("2 {} {}".format, mask, mask[1:])]
            one = ["1 0" if w[0].isdigit() else "1 " + w.lower() for w in words]
            # The word before a mark of a cut may be a part of one.
            if terminated(s) and not s.rstrip().endswith(("...", "…")):
                ended.update((two[-1], one[-1]))
            else:
                two.pop()
                one.pop()
            keys += two
            keys += one
        seen.update(keys)
    return seen, ended


_FINDINGS = ("closed", "marked", "broken", "open", "size", "single", "hanging", "keys")


def with_analysis(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the automaton's findings as the struct column `analysis`."""

    @F.pandas_udf("struct<closed:boolean,marked:boolean,broken:boolean,open:boolean,size:bigint,single:boolean,hanging:boolean,keys:array<string>>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([analyse(t) for t in b], columns=list(_FINDINGS))

    return df.withColumn("analysis", run(F.col(text)))


def contexts(df: DataFrame, text: str = "text") -> DataFrame:
    """(key, seen, ended): how often each context occurs and how often a closed sentence ends there.

    Keys are sent as 64-bit hashes; each Arrow batch is counted before anything is shuffled.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            seen, ended = count_contexts(b[text].tolist())
            if seen:
                yield pd.DataFrame({"context": list(seen), "seen": list(seen.values()), "ended": [ended[k] for k in seen]})

    rows = df.select(text).mapInPandas(run, "context string, seen bigint, ended bigint")
    return rows.select(F.xxhash64("context").alias("key"), "seen", "ended").groupBy("key").agg(F.sum("seen").alias("seen"), F.sum("ended").alias("ended"))


def _complete_share(bins: str) -> str:
    """SQL: of an array of (bin, n), the share of texts that are complete, by expectation and maximisation.

    2 ^ (bin / 4) is how much likelier the last words are at a sentence's end than anywhere.
    Half a complete text and one and a half that are cut are added, for sources with few.
    """
    likely = "(a * pow(2D, x.bin / 4D) / (a * pow(2D, x.bin / 4D) + 1 - a))"
    n = f"aggregate({bins}, 0D, (s, x) -> s + x.n)"
    return f"aggregate(sequence(1, 40), 0.25D, (a, i) -> (aggregate({bins}, 0D, (s, x) -> s + x.n * {likely}) + 0.5) / ({n} + 2))"


def field_limits(suspects: DataFrame, closed: DataFrame) -> DataFrame:
    """(_source, size): lengths at which unterminated texts pile up.

    Their number must pass what the lengths of the source's terminated texts (within ten
    characters) let expect by more than four standard deviations and three texts.
    """
    by = Window.partitionBy("_source")
    around = by.orderBy("size").rangeBetween(-10, 10)
    seen = suspects.groupBy("_source", "size").agg(F.count("*").alias("here"), F.lit(0).cast("bigint").alias("done"))
    done = closed.groupBy("_source", "size").agg(F.lit(0).cast("bigint").alias("here"), F.count("*").alias("done"))
    both = seen.unionByName(done).groupBy("_source", "size").agg(F.sum("here").alias("here"), F.sum("done").alias("done"))
    expected = F.sum("here").over(by) * (F.sum("done").over(around) + 1) / (21 * (F.sum("done").over(by) + 1))
    return both.withColumn("_e", expected).where("here > _e + 4 * sqrt(_e) + 3").select("_source", "size", F.lit(True).alias("at_limit"))


def cut_entries(entries: DataFrame, key: list[str], keep_prose, text: str = "text", source: str = "text_source", materialise=None) -> DataFrame:
    """The suspects with their findings, baselines, source and the verdict `cut`.

    `keep_prose` drops those suspects that aren't prose (see `quality`). `materialise` cuts the
    lineage after the automaton, so that it runs over the texts once; only suspects keep their text.
    """
    d = entries.select(*key, text, source)
    a = with_analysis(d, text).select(*key, F.when(~F.col("analysis.closed"), F.col(text)).alias(text), F.coalesce(source, F.lit("")).alias("_source"), "analysis.*")
    a = a.where("size > 0").withColumn("_id", F.monotonically_increasing_id())
    if materialise:
        a = materialise(a)
    closed = a.where("closed").select("_source", "size", "single")
    s = keep_prose(a.where("not closed")).drop(text, "closed")
    if materialise:
        s = materialise(s)
    plain = s.where("not marked and not broken and not open")
    share = plain.select("_source", "single", F.lit(0).alias("t")).unionByName(closed.select("_source", "single", F.lit(1).alias("t")))
    share = share.groupBy("_source", "single").agg(F.sum("t").alias("t"), F.count("*").alias("n"))
    whole = share.groupBy("_source").agg((F.sum("t") / F.sum("n")).alias("of_source"))
    share = share.join(whole, "_source").select("_source", "single", F.expr(f"(t + {BORROWED} * of_source) / (n + {BORROWED})").alias("terminated"))
    phrase = F.expr(f"single and terminated < {REGULAR}")
    limits = field_limits(plain.join(share, ["_source", "single"]).where(~phrase), closed)
    kinds = F.expr("inline(transform(keys, (k, i) -> struct(i as k, xxhash64(k) as key)))")
    x = plain.select("_id", kinds).join(contexts(entries.select(text), text), "key", "left")
    counts = [F.coalesce(F.max(F.when(F.col("k") == k, F.col(c))), F.lit(0)).alias(n) for n, k, c in (("n2", 0, "seen"), ("e2", 0, "ended"), ("n1", 1, "seen"), ("e1", 1, "ended"))]
    x = x.groupBy("_id").agg(*counts)
    factor = SENTENCE / (1 - THROUGH_WORD)
    one = f"(e1 + {SMOOTHING / factor / UNKNOWN}D) / (n1 + {SMOOTHING})"
    x = x.select("_id", F.expr(f"{factor}D * if(n1 = 0, {one}, (e2 + {SMOOTHING} * {one}) / (n2 + {SMOOTHING}))").alias("likelier"))
    g = s.join(x, "_id", "left").join(share, ["_source", "single"], "left").join(limits, ["_source", "size"], "left")
    g = g.withColumn("phrase", phrase).withColumn("at_limit", F.coalesce(F.col("at_limit") & ~F.col("phrase"), F.lit(False)))
    if materialise:
        g = materialise(g)
    open_ = g.where("likelier is not null and not at_limit and not hanging and not phrase")
    bins = open_.groupBy("_source", F.round(4 * F.log2("likelier")).cast("int").alias("bin")).agg(F.count("*").alias("n"))
    complete = bins.groupBy("_source").agg(F.collect_list(F.struct("bin", "n")).alias("_bins")).select("_source", F.expr(_complete_share("_bins")).alias("complete"))
    g = g.join(complete, "_source", "left")
    return g.drop("_id", "keys").withColumn("cut", F.expr("""case
        when marked or broken or open then true
        when likelier is null then false
        when phrase then false
        when at_limit or hanging then true
        else complete * likelier < 1 - complete end"""))


def source_report(entries: DataFrame, cut: DataFrame, source: str = "text_source") -> DataFrame:
    """(source, entries, cut, share) of each source; texts that are null or blank don't count."""
    n = entries.where("trim(text) <> ''").groupBy(F.coalesce(source, F.lit("")).alias("source")).agg(F.count("*").alias("entries"))
    c = cut.where("cut").groupBy(F.col("_source").alias("source")).agg(F.count("*").alias("cut"))
    return n.join(c, "source", "left").select("source", "entries", F.coalesce("cut", F.lit(0)).alias("cut"), F.round(F.coalesce("cut", F.lit(0)) / F.col("entries"), 6).alias("share"))
