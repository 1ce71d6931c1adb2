"""Inputs shared by the text operators."""

from __future__ import annotations

import json
import pkgutil
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaloom.session import checkpoint, ensure, spread, table  # noqa: F401

MODELS = Path(__file__).parent / "models"

#: Frequent function words, by language, after common published stop word lists.
COMMON_WORDS = {
    "en": "the of and a in to is it that for on with as by from at are its was which they this or an be has".split(),
    "de": "der die das und ist in den von mit im auf sich des ein eine nach wird dem als aus bei sie man nicht".split(),
    "fr": "le la les de des et est un une dans en du que qui se sur il elle pour par au son plus dont on".split(),
    "es": "el los las del y es una que se por con su para como al sus más lo muy entre sobre".split(),
    "pt": "o os as do da dos das e é um uma que em no na se com mais por seu sua ao não para".split(),
    "it": "il gli di che è un con per si nel della dei più non sono lo al alla i dopo".split(),
    "nl": "het een en van dat zijn op te voor met door aan wordt uit om niet er ook bij zich men".split(),
    "sv": "och att det som är en ett på av för med den till har när efter under sig i".split(),
    "pl": "i w na się z do że jest to od po który oraz nie ale przez jego około".split(),
    "ru": "и в на с что его не он как по от который к из за для но так или через при когда".split(),
}


def model_bytes(name: str) -> bytes:
    """A stored model, also from a package that was shipped as an archive."""
    return pkgutil.get_data(__package__, f"models/{name}")


def load_model(name: str) -> dict:
    return json.loads(model_bytes(name))


def descriptions(records: DataFrame) -> DataFrame:
    """(rec_id, locale, text, text_source): one row per entry of `descriptions`, null maps giving none."""
    return spread(records.select("rec_id", "description_sources", "descriptions")).select(
        "rec_id",
        F.col("description_sources").alias("_sources"),
        F.explode("descriptions").alias("locale", "text"),
    ).select("rec_id", "locale", "text", F.element_at("_sources", F.col("locale")).alias("text_source"))
