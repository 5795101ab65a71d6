"""Text expressions. All of them stay inside the JVM and inside generated code.

White space means the Unicode white space of Python's ``str``; Java's ``\\s`` and Spark's
``trim`` know less, so the class is written out.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Java's Unicode white space plus four control characters it leaves out. Single characters
# keep the class on the engine's fast path; ranges made it three times slower when measured.
_WS = r"\s\x1c\x1d\x1e\x1f"
_SPACE = f"(?U)[{_WS}]+"
_URL = f"(?U)https?://[^{_WS}]+"
_FENCED = r"```[\s\S]*?```"
_INLINE = r"`[^`]+`"
_CODE = f"{_FENCED}|{_INLINE}"


def _text(c) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def squeeze(c) -> Column:
    """Every run of white space becomes one space, the ends are trimmed, null becomes ''."""
    return F.trim(F.regexp_replace(_text(c), _SPACE, " "))


def is_blank(c) -> Column:
    """True where the text holds nothing but white space; null stays null."""
    c = F.col(c) if isinstance(c, str) else c
    return ~c.rlike(f"(?U)[^{_WS}]")


def code_blocks(c) -> Column:
    """Fenced and inline code spans, in text order."""
    return F.regexp_extract_all(_text(c), F.lit(_CODE), F.lit(0))


def replace_code(c) -> Column:
    """The text with each code span replaced by the mark ``[CODE]``."""
    return squeeze(F.regexp_replace(_text(c), _CODE, " [CODE] "))


def clean_text(c, remove_code: bool = False) -> Column:
    """Links become ``[URL]``, code may be dropped, white space is squeezed."""
    out = F.regexp_replace(_text(c), _URL, "[URL]")
    if remove_code:
        out = F.regexp_replace(F.regexp_replace(out, _FENCED, ""), _INLINE, "")
    return squeeze(out)


def word_count(c, squeezed: bool = False) -> Column:
    """Words between white space. ``squeezed`` says the text went through :func:`squeeze`."""
    text = _text(c) if squeezed else squeeze(c)
    spaces = F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))
    return (spaces + (F.length(text) > 0).cast("int")).cast("long")


def code_block_count(c) -> Column:
    text = _text(c)
    count = F.regexp_count(text, F.lit(_CODE)).cast("long")
    return F.when(F.contains(text, F.lit("`")), count).otherwise(F.lit(0).cast("long"))


def text_metrics(c, squeezed: bool = False) -> Column:
    """Struct of four counts: characters, words, sentence ends, code spans."""
    text = _text(c)
    return F.struct(
        F.length(text).cast("long").alias("char_count"),
        word_count(text, squeezed).alias("word_count"),
        F.regexp_count(text, F.lit("[.!?]+")).cast("long").alias("sentence_count"),
        code_block_count(text).alias("code_block_count"),
    )
