"""HTML expressions. Only unusual entities need Python."""

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _text, squeeze


# Names of HTML with their characters. The ampersand is decoded last.
USUAL_ENTITIES = {
    "lt": "<", "gt": ">", "quot": '"', "apos": "'", "#39": "'", "#34": '"', "nbsp": "\u00a0", "copy": "\u00a9",
    "reg": "\u00ae", "middot": "\u00b7", "ndash": "\u2013", "mdash": "\u2014", "lsquo": "\u2018", "rsquo": "\u2019",
    "ldquo": "\u201c", "rdquo": "\u201d", "hellip": "\u2026", "amp": "&",
}


def _entity_decoder():
    unescape = html.unescape

    @F.pandas_udf("string")
    def decode(texts: pd.Series) -> pd.Series:
        return texts.map(unescape, na_action="ignore")

    return decode


def clean_html(c) -> Column:
    """Tags become spaces, then entities are decoded, then white space is squeezed.

    Usual entities are replaced in place. Only texts with others, or with names that lack their
    semicolon, travel to the Python workers; the rest are null there.
    """
    stripped = F.regexp_replace(_text(c), "<[^>]+>", " ")
    decoded = _entity_decoder()(F.when(~has_usual_entities_only(stripped), stripped))
    usual = stripped
    for name, character in USUAL_ENTITIES.items():
        usual = F.replace(usual, F.lit(f"&{name};"), F.lit(character))
    return squeeze(F.coalesce(decoded, usual))


def has_usual_entities_only(text: Column) -> Column:
    """True where every ampersand begins a usual entity or can begin none."""
    known = "|".join(USUAL_ENTITIES)
    return ~F.regexp_replace(text, f"&(?:{known});", "").rlike("&[#A-Za-z]")


def tag_list(c) -> Column:
    """``<a><b>`` as the array ``[a, b]``."""
    return F.regexp_extract_all(_text(c), F.lit("<([^>]+)>"), F.lit(1))


def has_leftover_tags(c) -> Column:
    """True where a lower-case tag without attributes is left in the text; null is false."""
    return _text(c).rlike("<[a-z]+>")
