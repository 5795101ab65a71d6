"""Feature expressions over cleaned questions and answers."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import defaults as D
from .numeric import python_round
from .phrases import phrases_found
from .text import _text, code_block_count, word_count

# Dotted I, dotless i, long s.
_ODD_LETTERS = "\u0130\u0131\u017f"


def fold_case(c) -> Column:
    """Lower case under which the letters i, k and s equal all their case variants.

    Dotted and dotless i and the long s do not lower-case to ASCII, but a case-insensitive
    Unicode search takes them as i and s.
    """
    text = _text(c)
    odd = F.lit(False)
    for letter in _ODD_LETTERS:
        odd = odd | F.contains(text, F.lit(letter))
    return F.lower(F.when(odd, F.translate(text, _ODD_LETTERS, "iis")).otherwise(text))


def _holds_any(text: Column, phrases) -> Column:
    """True where a phrase occurs. A phrase that contains another one can be left out."""
    terms = list(dict.fromkeys(p.lower() for p in phrases))
    found = F.lit(False)
    for term in terms:
        if not any(other != term and other in term for other in terms):
            found = found | F.contains(text, F.lit(term))
    return found


def _labels_of(lexicon):
    """Arrow function from texts, as bytes, to the labels with a phrase in them."""
    phrases = [(label, p.lower().encode()) for label, rule in lexicon.items() for p in rule]
    labels = list(lexicon)

    @F.arrow_udf("array<string>")
    def found(texts: pa.Array) -> pa.Array:
        hits = phrases_found(texts, [p for _, p in phrases])
        by_label = np.column_stack([
            hits[:, [j for j, (of, _) in enumerate(phrases) if of == label]].any(axis=1) for label in labels])
        offsets = np.concatenate([[0], np.cumsum(by_label.sum(axis=1))]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(labels).take(pa.array(np.nonzero(by_label)[1])))

    return found


def labels_found(folded, lexicon) -> Column:
    """Labels, in lexicon order, whose phrases occur in a text from :func:`fold_case`.

    A value of ``lexicon`` is a list of plain phrases or one regular expression.
    Plain phrases become substring searches, far cheaper than case-insensitive patterns; where there
    are no others, one pass over the bytes looks for all of them.
    """
    folded = F.col(folded) if isinstance(folded, str) else folded
    if lexicon and not any(isinstance(rule, str) for rule in lexicon.values()):
        return _labels_of(lexicon)(folded.cast("binary"))
    marks = []
    for label, rule in lexicon.items():
        hit = folded.rlike(f"(?iu){rule}") if isinstance(rule, str) else _holds_any(folded, rule)
        marks.append(F.when(hit, F.lit(label)))
    nothing = F.array(F.lit(None).cast("string"))
    return F.array_except(F.array(*marks), nothing) if marks else F.array().cast("array<string>")


def error_signatures(c, lexicon=None) -> Column:
    return labels_found(fold_case(c), D.ERROR_LEXICON if lexicon is None else lexicon)


def infra_components(c, lexicon=None) -> Column:
    return labels_found(fold_case(c), D.INFRA_LEXICON if lexicon is None else lexicon)


def first_matching_group(lowered, groups, other: str) -> Column:
    """Name of the first group with a phrase in a lower-cased text, else ``other``."""
    text = F.col(lowered) if isinstance(lowered, str) else lowered
    names = list(groups)
    out = F.when(_holds_any(text, groups[names[0]]), F.lit(names[0]))
    for name in names[1:]:
        out = out.when(_holds_any(text, groups[name]), F.lit(name))
    return out.otherwise(F.lit(other))


def question_type(c) -> Column:
    return first_matching_group(F.lower(_text(c)), D.QUESTION_TYPES, D.OTHER_QUESTION_TYPE)


def complexity_from_counts(words, blocks) -> Column:
    return (
        F.when((words < 50) & (blocks == 0), F.lit("simple"))
        .when((words < 200) | (blocks <= 1), F.lit("moderate"))
        .otherwise(F.lit("complex"))
    )


def complexity_class(c) -> Column:
    """simple, moderate or complex, from the number of words and of code spans."""
    return complexity_from_counts(word_count(c), code_block_count(c))


def quality_score(score, answer_score, views, question_words, answer_words, answer_blocks) -> Column:
    """Votes, popularity, length and code examples in one number with two decimals.

    The terms are added in this order because the last bit decides some roundings.
    """
    def zero(c):
        return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(0)).cast("double")

    total = (
        zero(score) * F.lit(2.0)
        + zero(answer_score) * F.lit(3.0)
        + zero(views) * F.lit(0.001)
        + F.least(zero(question_words) / F.lit(50.0), F.lit(2.0))
        + F.least(zero(answer_words) / F.lit(100.0), F.lit(3.0))
        + zero(answer_blocks) * F.lit(0.5)
    )
    return python_round(total, 2)


def comma_joined(c) -> Column:
    """An array of strings as one text; null as ''."""
    return F.concat_ws(", ", F.col(c) if isinstance(c, str) else c)
