"""Queries over all rows, where the SQL twins see a part: against brute force on a small fixture."""

import hashlib
import unicodedata
from urllib.parse import quote

import pytest

from taxaloom.plans import registry

NAMES = [
    (1, "en", "Élan", "inat"), (2, "pl", "Ślązak łąkowy", "wiki"), (3, "ru", "Ёжик й", "ebird"), (4, "nl", "Gro\u0308te e\u0301end", "wiki"), (5, "ja", "\uff26\uff55\uff4c\uff4c \u30ac", None),
    (6, "en", None, "inat"), (7, "de", "", "wiki"), (8, "en", "O'Neill's Red-eyed Owl", "ebird"), (9, "sv", "Ångström", "inat"), (10, "en", "Barn Owl", "ebird"),
]
RECORDS = [(1, "Élan d'été", "Alces alces"), (2, "Barn-Owl (pale)", "Tyto é"), (3, None, "Bubo bubo"), (4, "Owl", None), (5, "雪 Owl & 50%", "Pica pica")]


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("small"))
    spark.createDataFrame(NAMES, "name_id bigint, locale string, common_name string, name_source string").write.parquet(f"{d}/name_rows.parquet")
    spark.createDataFrame([(*r, None) for r in RECORDS], "rec_id bigint, common_name string, scientific_name string, inat_id bigint").write.parquet(f"{d}/species_records.parquet")
    return d


def rows(spark, small, name):
    return {r[0]: tuple(r)[1:] for r in registry.queries()[name](spark, small).collect()}


def test_accent_fold(spark, small):
    want = {i: ("".join(c for c in unicodedata.normalize("NFD", (n or "").lower()) if not unicodedata.combining(c)),) for i, _, n, _ in NAMES}
    got = rows(spark, small, "accent_fold_all")
    assert got == want and got[2] == ("slazak łakowy",) and got[3] == ("ежик и",) and got[4] == ("grote eend",)


def test_media_urls(spark, small):
    want = {}
    for i, name, sci in RECORDS:
        f = None if name is None else f"{name}.jpg".replace(" ", "_")
        h = hashlib.md5((f or "").encode()).hexdigest()
        url = f and f"https://upload.wikimedia.org/wikipedia/commons/{h[0]}/{h[:2]}/{quote(f, safe='')}"
        want[i] = (url, sci and hashlib.sha256(sci.encode()).hexdigest()[:16])
    assert rows(spark, small, "media_urls_all") == want


def test_author_lines(spark, small):
    assert rows(spark, small, "author_lines_all") == {i: (n or "",) for i, _, n, _ in NAMES}
