import random

from hypothesis import given, settings
from hypothesis import strategies as st

from taxaloom.llm import leakage as L

ITEM = "a visiting choir counted twenty orphaned bats beside the old ice house because the tide had turned early that day"


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=12), min_size=1, max_size=4), st.lists(st.integers(0, 4), max_size=15))
def test_automaton_as_by_brute_force(items, seq):
    a = L.Automaton(items)
    for end, n, state in a.matches(seq, 1):
        piece = seq[end - n + 1 : end + 1]
        where = sorted((i, j + n - 1) for i, s in enumerate(items) for j in range(len(s) - n + 1) if s[j : j + n] == piece)
        assert where and sorted(set(a.occurrences(state))) == where
        assert end + 1 == len(seq) or not any(s[j : j + n + 1] == seq[end - n + 1 : end + 2] for s in items for j in range(len(s)))
    longest = max((n for _, n, _ in a.matches(seq, 1)), default=0)
    want = max((k for i in range(len(seq)) for k in range(1, len(seq) - i + 1) if any(s[j : j + k] == seq[i : i + k] for s in items for j in range(len(s)))), default=0)
    assert longest == want


def index(items):
    return L.Index(L.without_instructions(items))


def found(text, items=((1, ITEM),)):
    return {i for i, *_ in index(list(items)).search(text)}


def test_whole_part_and_changed():
    w = ITEM.split()
    assert found(f"before it {ITEM} and after") == {1} and found(" ".join(w[3:16])) == {1} and found(" ".join(w[3:13])) == set()
    assert found(", ".join(w).upper()) == {1} and found(ITEM.replace("a", "а").replace("e", "е")) == {1} and found("\n> **".join(w)) == {1}
    changed = [*w[:8], "some", *w[9:14], "quite", *w[15:]]
    assert found(" ".join(changed)) == {1}
    shuffled = w[:]
    random.Random(3).shuffle(shuffled)
    assert found(" ".join(shuffled)) == set()
    assert found(None) == set() and found("") == set()


def test_split_words_and_hyphens():
    t = ITEM.replace("orphaned", "orph-\naned").replace("turned", "tur­ned")
    assert found(t) == {1}


def test_instructions_do_not_count():
    items = [(i, f"Read the passage with care and answer all of the questions below in your own words now. {x}") for i, x in enumerate(["one two three four", "five six", "seven eight nine", "ten eleven"])]
    assert found("Read the passage with care and answer all of the questions below in your own words now.", items) == set()


def test_over_spark(spark):
    docs = spark.createDataFrame([(10, f"x {ITEM} y", "e"), (11, None, "e"), (12, "", "e"), (13, "nothing here", "e"), (10, f"x {ITEM} y", "e"), (14, "z " * 100_000 + ITEM, "e")], "doc_id bigint, text string, item_id string")
    items = spark.createDataFrame([(1, ITEM), (2, None), (3, ""), (4, ITEM)], "item_id bigint, text string")
    got = L.find_leaks(docs, items)
    assert sorted((r.item_id, r.doc_id) for r in got.collect()) == [(1, 10), (1, 10), (1, 14), (4, 10), (4, 10), (4, 14)]
    assert L.find_leaks(docs.where("false"), items).count() == 0 and L.find_leaks(docs, items.where("false")).count() == 0


def test_many_items_are_searched_in_turns(spark, monkeypatch):
    monkeypatch.setattr(L, "MOST_ITEM_WORDS", 60)
    w = [f"w{i}" for i in range(400)]
    items = spark.createDataFrame([(str(i), " ".join(w[i * 10 : i * 10 + 20])) for i in range(30)] + [("long", " ".join(w[300:]))], "item_id string, text string")
    docs = spark.createDataFrame([(i, " ".join(w[i * 10 : i * 10 + 14])) for i in range(30)], "doc_id bigint, text string")
    assert len(L._indexes(items, "item_id", "text")) > 4
    got = sorted((r.item_id, r.doc_id) for r in L.find_leaks(docs, items).collect())
    assert got == sorted((str(i), i) for i in range(30))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=12), min_size=1, max_size=4), st.lists(st.integers(0, 3), max_size=15))
def test_matches_of_every_item_by_brute_force(items, seq):
    want = set()
    for i, s in enumerate(items):
        for a in range(len(s)):
            for d in range(len(seq)):
                k = 0
                while a + k < len(s) and d + k < len(seq) and s[a + k] == seq[d + k]:
                    k += 1
                if k >= 2 and (a == 0 or d == 0 or s[a - 1] != seq[d - 1]):
                    want.add((i, a, d, k))
    got = [m[:4] for m in L.Automaton(items).placed(seq, 2)]
    assert len(got) == len(set(got)) and set(got) == want


def test_nested_and_overlapping_items():
    w = [f"w{i}" for i in range(40)]
    items = [w, w[:14], w[26:], w[10:24], [*w[5:18], *"other words behind it".split()], [*"new words before".split(), *w[30:]], [*"x y z".split(), *w[8:22], *"a b".split()]]
    text = " ".join(["before", *w, "after"])
    long = {i for i, s in enumerate(items) if any(" ".join(s[a : a + 12]) in text for a in range(len(s) - 11))}
    assert long == {0, 1, 2, 3, 4, 6} and found(text, [(i, " ".join(s)) for i, s in enumerate(items)]) == long


def test_shared_phrases_are_no_leak():
    items = [(i, f"while the bells rang twice between {y} and the flood three cyclists moved {x} geese") for i, (y, x) in enumerate([("1966", "marked"), ("1903", "wild")])]
    longer = (9, "so it was while the bells rang twice between meals")
    assert found("so it was while the bells rang twice between 1777 and the flood three cyclists moved on", [*items, longer]) == set()


def test_chain_over_many_seeds_at_one_place():
    i = index([(1, " ".join(f"x{i}" for i in range(200)))])
    seeds = [(0, 0, 11), *[(12, 100 + i, 3) for i in range(45)], (12, 180, 8)]
    assert i._join([*seeds, (12, 12, 8)], 12, 200)[0] == (0, 20, 19)
    assert i._join([(0, 50, 11), *[(1 + i % 9, 80 + i, 3) for i in range(90)], (12, 62, 8)], 12, 200)[0] == (0, 20, 19)


def test_changed_words_in_a_short_piece_and_inside_longer_items():
    w = ITEM.split()
    assert found(" ".join([*w[:8], "otherwise", *w[9:13]])) == {1}
    # The copy matches a longer item up to the changed words, the excerpt is found beside it.
    items = [(1, ITEM), (2, " ".join(w[2:18]))]
    assert found(" ".join([*w[:10], "some", *w[11:]]), items) == {1, 2}


def test_instruction_of_two_items_and_common_beginnings():
    head = "Please read the short passage with care and answer each of the questions below."
    assert found(head, [(1, f"{head} one two three four"), (2, f"{head} five six seven eight")]) == set()
    assert found(head, [(1, f"{head} one two three four"), (2, f"{head} one two three four five")]) == {1, 2}


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aéÉ'’ß ﬁ-\n\u00ad\u0301.İ１ж а1", max_size=30))
def test_places_of_words(text):
    words, at = L.located(text)
    assert words == L.tokens(text)
    assert all(0 <= a < z <= len(text) for a, z in at) and all(x[1] <= y[0] or x == y or x[0] <= y[0] for x, y in zip(at, at[1:]))


def test_removal(spark):
    docs = spark.createDataFrame([(1, f"Before it. {ITEM.upper()}. And after.", "k"), (2, None, "k"), (3, "", "k"), (4, f"{ITEM} {ITEM}", "k"), (5, "nothing", "k"), (5, "nothing", "k")], "doc_id bigint, text string, _cut string")
    items = spark.createDataFrame([(1, ITEM), (2, " ".join(ITEM.split()[:15]))], "item_id bigint, text string")
    got = sorted(((r.doc_id, r.text, r.removed_words) for r in L.without_leaks(docs.withColumnRenamed("_cut", "item_id"), items).collect()), key=str)
    n = len(ITEM.split())
    assert got == [(1, "Before it. . And after.", n), (2, None, 0), (3, "", 0), (4, "", 2 * n), (5, "nothing", 0), (5, "nothing", 0)]
    assert {(r.item_id, r.start, r.end) for r in L.find_leaks(docs.where("doc_id = 1"), items).collect()} == {(1, 11, 11 + len(ITEM)), (2, 11, 11 + len(" ".join(ITEM.split()[:15])))}
