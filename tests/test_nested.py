import json
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from taxaloom.operators import nested

SCHEMA = "raw_id bigint, payload string"


def brute(payload):
    """All children by walking the parsed payload."""
    try:
        doc = json.loads(payload) if payload is not None else None
    except ValueError:
        return set()
    if not isinstance(doc, dict):
        return set()
    records = [r for r in doc.get("records") or [] if isinstance(r, dict)] if isinstance(doc.get("records"), list) else []
    records += [doc["record"]] if isinstance(doc.get("record"), dict) else []
    if "record" not in doc and "records" not in doc:
        records = [doc]
    seen, out = Counter(), set()

    def step(kind, locale):
        seen[kind, locale] += 1
        return seen[kind, locale]

    def entries(v):
        if isinstance(v, list):
            return [(e.get("locale") if isinstance(e, dict) else None, e) for e in v]
        return list(v.items()) if isinstance(v, dict) else []

    def text(e, f):
        e = e.get(f) if isinstance(e, dict) else e
        return isinstance(e, str) and e.strip() != ""

    def listed(v):
        return v if isinstance(v, list) else [v]

    for r in records:
        for loc, e in entries(r.get("descriptions")):
            if loc is None:
                continue
            p = step("descriptions", loc)
            if isinstance(e, dict) or text(e, ""):
                out.add(("descriptions", loc, p))
            for q in listed(e.get("paragraphs") if isinstance(e, dict) else e):
                p = step("paragraphs", loc)
                if text(q, "text"):
                    out.add(("paragraphs", loc, p))
        for kind, many, field in (("common_names", "values", "name"), ("wikipedia_urls", "url", "url")):
            for loc, e in entries(r.get(kind)):
                if loc is None:
                    continue
                for q in listed(e.get(many) if isinstance(e, dict) else e):
                    p = step(kind, loc)
                    if text(q, field):
                        out.add((kind, loc, p))
        for q in listed(r.get("scientific_name_aliases")):
            p = step("a", "")
            if text(q, "name"):
                out.add(("scientific_name_aliases", "", p))
    return out


leaf = st.one_of(st.none(), st.sampled_from(["", " ", "text", "ж"]))
locale = st.sampled_from(["en", "de", "pt-br"])
para = st.one_of(leaf, st.fixed_dictionaries({}, optional={"text": leaf, "n": st.integers(0, 3), "refs": st.just([])}))
desc = st.one_of(st.none(), st.fixed_dictionaries({}, optional={"locale": locale, "paragraphs": st.one_of(leaf, st.lists(para, max_size=3))}))
name = st.fixed_dictionaries({}, optional={"locale": locale, "values": st.lists(st.one_of(leaf, st.fixed_dictionaries({"name": leaf})), max_size=3)})
record = st.fixed_dictionaries(
    {},
    optional={
        "descriptions": st.one_of(st.none(), st.lists(desc, max_size=3), st.dictionaries(locale, desc, max_size=2)),
        "common_names": st.one_of(st.lists(name, max_size=3), st.dictionaries(locale, st.one_of(leaf, st.lists(leaf, max_size=3)), max_size=2)),
        "wikipedia_urls": st.one_of(st.none(), st.dictionaries(locale, leaf, max_size=2), st.lists(st.fixed_dictionaries({"locale": locale, "url": leaf}), max_size=2)),
        "scientific_name_aliases": st.one_of(leaf, st.lists(st.one_of(leaf, st.fixed_dictionaries({"name": leaf, "status": leaf})), max_size=3)),
    },
)
payload = st.one_of(st.builds(lambda r: {"record": r}, record), st.builds(lambda r: {"records": r}, st.lists(record, max_size=2)))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(payload, min_size=1, max_size=25))
def test_same_children_as_a_walk(spark, docs):
    rows = [(i, json.dumps(d, ensure_ascii=i % 2 == 0)) for i, d in enumerate(docs)]
    got = {tuple(r) for r in nested.children(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {(i, *c) for i, p in rows for c in brute(p)}


def test_unreadable_payloads_give_nothing(spark):
    rows = [(1, None), (2, ""), (3, "null"), (4, '{"record": {"descr'), (5, "[1, 2]"), (6, "7"), (7, '{"record": null}'), (8, '{"records": []}')]
    assert nested.children(spark.createDataFrame(rows, SCHEMA)).count() == 0
    assert nested.children(spark.createDataFrame([], SCHEMA)).count() == 0


def test_extra_columns_repeats_and_long_lists(spark):
    doc = json.dumps({"record": {"common_names": {"en": [f"n{i}" for i in range(3000)]}}})
    d = spark.createDataFrame([(1, doc, "x", "y"), (1, doc, None, None)], "raw_id bigint, payload string, records string, entries string")
    got = nested.common_names(d)
    assert got.count() == 6000 and got.distinct().count() == 3000
    assert got.agg({"pos": "max"}).first()[0] == 3000


def test_links_to_the_parent(spark):
    doc = json.dumps({"record": {"descriptions": [{"locale": "en", "paragraphs": ["a"]}, {"locale": "en", "source": {"kind": "llm"}, "paragraphs": [{"text": "b"}, {"text": "c"}]}]}})
    d = spark.createDataFrame([(1, doc)], SCHEMA)
    assert [tuple(r) for r in nested.paragraphs(d).orderBy("pos").collect()] == [(1, 1, 1, "en", 1, 1, "a"), (1, 1, 2, "en", 2, 2, "b"), (1, 1, 2, "en", 3, 2, "c")]
    assert [r.source_kind for r in nested.descriptions(d).orderBy("pos").collect()] == [None, "llm"]


def test_links_to_the_record_and_entry(spark):
    a = {"common_names": [{"values": ["lost"]}, {"locale": "en", "values": ["a1", "a2"]}], "descriptions": {"en": {"paragraphs": ["pa"]}}, "scientific_name_aliases": ["x"]}
    b = {"common_names": [{"locale": "en", "values": "b1"}], "descriptions": [None, {"locale": "en", "paragraphs": ["pb"]}], "scientific_name_aliases": [{"name": "y", "status": "s"}]}
    d = spark.createDataFrame([(1, json.dumps({"records": [a, None, b]}))], SCHEMA)
    assert [tuple(r) for r in nested.common_names(d).orderBy("pos").collect()] == [(1, 1, 2, "en", 1, "a1"), (1, 1, 2, "en", 2, "a2"), (1, 3, 1, "en", 3, "b1")]
    assert [tuple(r) for r in nested.paragraphs(d).orderBy("pos").collect()] == [(1, 1, None, "en", 1, 1, "pa"), (1, 3, 2, "en", 2, 2, "pb")]
    assert [tuple(r)[:5] for r in nested.descriptions(d).orderBy("pos").collect()] == [(1, 1, None, "en", 1), (1, 3, 2, "en", 2)]
    assert [tuple(r) for r in nested.scientific_name_aliases(d).orderBy("pos").collect()] == [(1, 1, 1, "x", None), (1, 3, 2, "y", "s")]


def test_rejects(spark):
    rows = [(1, None), (2, " "), (3, "null"), (4, '{"record": {"descr'), (5, "[1, 2]"), (7, '{"record": null}'), (8, '{"records": []}'), (9, '{"record": {}}'), (9, '{"x": 1}')]
    got = {r.raw_id: r.reason for r in nested.rejects(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: "empty", 2: "empty", 3: "no_object", 4: "broken", 5: "no_object", 7: "no_record", 8: "no_record"}


def test_no_shuffle_and_no_python(spark, sf):
    d = nested.children(spark.read.parquet(f"{sf}/raw_records.parquet"))
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
