"""Extracts of long texts, as expressions over arrays: a description's opening paragraphs, and text ended at a boundary.

A value that several places need is bound once as a lambda variable (`let`), so that nothing is
evaluated twice. All of it runs in the JVM.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from taxaloom.functions.text import col, normalize_space, null_to_blank, strip, word_count

#: Headings after which an article has no description any more.
CLOSING_HEADINGS = ("references", "external links", "further reading", "see also")
#: What ends a sentence, in the order in which an end is looked for.
SENTENCE_MARKS = (". ", "! ", "? ", ".\n", "!\n", "?\n")
#: The same for texts that get an ellipsis where no sentence ends.
ELLIPSIS_MARKS = (". ", ".\n", "! ", "? ")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value evaluated once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _leading(sizes: Column, enough: Callable[[Column, Column], Column]) -> Column:
    """struct(n, words): how many leading elements are taken until there is enough, and their words."""
    none = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("words"))
    return F.aggregate(sizes, none, lambda a, s: F.when(enough(a["n"], a["words"]), a).otherwise(F.struct((a["n"] + 1).alias("n"), (a["words"] + s).alias("words"))))


def paragraphs(c) -> Column:
    """The non-blank paragraphs of a text, each with single blanks."""
    t = strip(F.regexp_replace(null_to_blank(c), r"\r\n?", "\n"))
    return F.filter(F.transform(F.split(t, r"\n{2,}"), normalize_space), lambda p: p != "")


def opening(parts: Column, most: int) -> Column:
    """At most `most` leading paragraphs, none from a closing heading on."""
    heading = rf"(?iU)^(?:{'|'.join(CLOSING_HEADINGS)})\b"
    at = F.array_position(F.transform(parts, lambda p: p.rlike(heading)), True)
    return F.slice(parts, 1, F.least(F.lit(most), F.when(at > 0, at - 1).otherwise(F.size(parts))).cast("int"))


def selected_description(c, least: int, target: int, extra: int = 2, fewest: int = 1) -> Column:
    """Opening paragraphs of an article, until there are `fewest` and enough words; '' for none.

    Fewer paragraphs than `fewest` that hold far more words than wanted are shortened to leading
    sentences of `target` words. Null gives ''.
    """
    fewest, goal = max(1, fewest), max(least, target)

    def of(parts: Column) -> Column:
        return let(_leading(F.transform(parts, word_count), lambda n, w: (n >= fewest) & (w >= goal)), lambda got: chosen(parts, got))

    def chosen(parts: Column, got: Column) -> Column:
        whole = F.array_join(F.slice(parts, F.lit(1), got["n"].cast("int")), "\n\n")
        few = (got["n"] < fewest) & (got["words"] > max(2 * target, least))
        return F.when(few, let(F.filter(F.split(whole, r"(?<=[.!?])\s+"), lambda s: s != ""), shortened)).otherwise(whole)

    def shortened(sentences: Column) -> Column:
        n = _leading(F.transform(sentences, word_count), lambda n, w: (n > 0) & (w >= target))["n"]
        return F.array_join(F.slice(sentences, F.lit(1), n.cast("int")), " ")

    return let(opening(paragraphs(c), max(1, 1 + extra)), of)


def _last(head: Column, mark: str) -> Column:
    """Characters before the last place of a mark, null without one."""
    back = F.instr(F.reverse(head), mark[::-1])
    return F.when(back > 0, F.length(head) - back - (len(mark) - 1))


def _end(head: Column, marks: tuple[str, ...], least: Column | int) -> Column:
    """Characters up to the first kind of mark that stands at `least` or later, with its sign; null for none."""
    return F.coalesce(*[let(_last(head, m), lambda at: F.when(at >= least, at + 1)) for m in marks])


def ended_at_sentence(c, most) -> Column:
    """At most `most` characters: to a sentence's end in the last two thirds, else a word's, else hard. Null gives ''."""
    most = most if isinstance(most, Column) else F.lit(most)
    low = F.floor(most / 3)

    def cut(t: Column) -> Column:
        return let(F.substring(t, F.lit(1), most), lambda h: strip(F.substring(h, F.lit(1), F.coalesce(_end(h, SENTENCE_MARKS, low), let(_last(h, " "), lambda at: F.when(at >= low, at)), F.length(h)))))

    return let(strip(null_to_blank(c)), lambda t: F.when((most <= 0) | (F.length(t) <= most), t).otherwise(cut(t)))


def ended_with_ellipsis(c, most: int) -> Column:
    """At most `most` characters: to a sentence's end past the half, else to a word's end and an ellipsis. Null gives ''."""

    def cut(h: Column) -> Column:
        word = F.concat(F.substring(h, F.lit(1), F.coalesce(_last(h, " "), F.length(h))), F.lit("…"))
        return let(_end(h, ELLIPSIS_MARKS, most // 2 + 1), lambda n: F.when(n.isNull(), word).otherwise(F.substring(h, F.lit(1), n)))

    t = null_to_blank(col(c))
    return F.when(F.length(t) <= most, t).otherwise(let(F.substring(t, 1, most), cut))
