"""Text expressions against plain Python restatements."""

import html
import random
import re
import sys

import pytest
from pyspark.sql import functions as F

from qalathe import defaults as D
from qalathe import functions as fx

CODE = re.compile(r"```[\s\S]*?```|`[^`]+`")


def column_values(spark, texts, expression):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in rows.orderBy("i").select(expression).collect()]


def random_texts(seed, n=300):
    rng = random.Random(seed)
    parts = [
        "How do I", "why does", "fix", "crash", "oom", "OOMKilled", "timeıng", "TIMEOUT", "tİmeout",
        "reſolve", "Kubernetes", "config", "403", "`a b`", "```x\ny```", "`", "```", "https://a.b/c?d=1",
        "http://x`y", "httpx", ".", "!?", "...", "\n", "\t", " ", "  ", " ", " ", "\x1c", "\x0b", "\x85",
        "　", "世界", "Привет", "🚀", "<b>", "&amp;", "&lt;p&gt;", "word", "Word.", "é", "&", "&copy", "</i >",
    ]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(n)]


def squeeze(t):
    return re.sub(r"\s+", " ", t).strip()


def clean(t):
    return squeeze(re.sub(r"https?://\S+", "[URL]", t))


def test_white_space_class_is_pythons(spark):
    points = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF and c != 0]
    spaces = [c for c in points if re.match(r"\s", c)]
    others = random.Random(1).sample(points, 3000)
    texts = [f"a{c}b" for c in spaces + others]
    assert column_values(spark, texts, fx.squeeze("t")) == [squeeze(t) for t in texts]


@pytest.mark.parametrize("seed", [1, 2])
def test_cleaning_and_metrics(spark, seed):
    texts = random_texts(seed)
    assert column_values(spark, texts, fx.squeeze("t")) == [squeeze(t) for t in texts]
    assert column_values(spark, texts, fx.clean_text("t")) == [clean(t) for t in texts]
    assert column_values(spark, texts, fx.code_blocks("t")) == [CODE.findall(t) for t in texts]
    assert column_values(spark, texts, fx.replace_code("t")) == [squeeze(CODE.sub(" [CODE] ", t)) for t in texts]
    assert column_values(spark, texts, fx.is_blank("t")) == [t.strip() == "" for t in texts]
    want = [(len(t), len(t.split()), len(re.findall(r"[.!?]+", t)), len(CODE.findall(t))) for t in texts]
    assert [tuple(m) for m in column_values(spark, texts, fx.text_metrics("t"))] == want
    cleaned = [clean(t) for t in texts]
    quick = column_values(spark, cleaned, fx.text_metrics("t", squeezed=True))
    assert [m.word_count for m in quick] == [len(t.split()) for t in texts]


def test_code_removal(spark):
    texts = ["a ```x\n y``` b `c` d", "`open"]
    assert column_values(spark, texts, fx.clean_text("t", remove_code=True)) == ["a b d", "`open"]


def plain(t):
    return squeeze(html.unescape(re.sub(r"<[^>]+>", " ", t))) if t else ""


def test_html(spark):
    texts = [*random_texts(3), None, "", "<p>Hello <strong>World</strong></p>", "&lt;div&gt; &amp;amp; &#39;x&#39;"]
    assert column_values(spark, texts, fx.clean_html("t")) == [plain(t) for t in texts]
    assert column_values(spark, ["<a><b c>", None, ""], fx.tag_list("t")) == [["a", "b c"], [], []]
    assert column_values(spark, ["x <div> y", "<DIV>", None, "<a href>"], fx.has_leftover_tags("t")) == [
        True, False, False, False]


@pytest.mark.parametrize("lexicon", [D.ERROR_LEXICON, D.INFRA_LEXICON])
def test_labels(spark, lexicon):
    texts = random_texts(4) + [f"x {p.upper()} y" for ps in lexicon.values() for p in ps] + [
        p.lower()[:-1] for ps in lexicon.values() for p in ps]

    def found(t):
        return [label for label, phrases in lexicon.items()
                if re.search("|".join(map(re.escape, phrases)), t, re.IGNORECASE)]

    got = column_values(spark, texts, fx.labels_found(fx.fold_case("t"), lexicon))
    assert got == [found(t) for t in texts]


def test_lexicon_may_hold_a_pattern(spark):
    rule = {"number": r"\d{3}", "word": ("abc",)}
    assert column_values(spark, ["x 123 ABC", "12"], fx.labels_found(fx.fold_case("t"), rule)) == [
        ["number", "word"], []]


def test_question_type_and_complexity(spark):
    texts = ["How do I configure X?", "I need to fix this crash", "Why is it so?", "What are pods?",
             "An exception", "Should I use it?", "Tell me", None]
    assert column_values(spark, texts, fx.question_type("t")) == [
        "how_to", "troubleshooting", "explanation", "definition", "error_resolution", "best_practice",
        "general", "general"]
    texts = ["Short text", "A " * 60, "x `a`", "A " * 300 + "`a`" * 1, "A " * 300 + "`a` " * 3, ""]
    assert column_values(spark, texts, fx.complexity_class("t")) == [
        "simple", "moderate", "moderate", "moderate", "complex", "simple"]


def test_rounding_is_pythons(spark):
    rng = random.Random(5)
    values = [rng.uniform(-5000, 5000) for _ in range(3000)] + [i / 1000 + 0.005 for i in range(3000)]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double").orderBy("i")
    for digits in (2, 3, 4):
        got = [r[0] for r in rows.select(fx.python_round("v", digits)).collect()]
        assert got == [round(v, digits) for v in values]


def test_integers_from_text(spark):
    texts = ["5", " 5 ", "+5", "-3", "5.0", "", None, "n/a", " "]
    assert column_values(spark, texts, fx.int_or_zero("t")) == [5, 5, 5, -3, None, 0, 0, None, None]
    assert column_values(spark, texts, fx.strict_int("t")) == [5, 5, 5, -3, None, None, None, None, None]


def test_comma_joined(spark):
    rows = spark.createDataFrame([(["a", "b"],), ([],), (None,)], "t array<string>")
    assert [r[0] for r in rows.select(fx.comma_joined("t")).collect()] == ["a, b", "", ""]


def test_only_unusual_entities_reach_python(spark):
    usual = ["a &amp; b", "&amp;lt; stays", "&&amp;&lt;", "5 & 6", "&", "&quot;x&#39;&nbsp;&copy;"]
    other = ["&eacute;", "&ampfoo", "&#169;", "&copy2", "&unknown;"]
    assert column_values(spark, usual + other, fx.html.has_usual_entities_only(F.col("t"))) == [True] * 6 + [False] * 5
    assert column_values(spark, usual + other, fx.clean_html("t")) == [plain(t) for t in usual + other]
    share = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").agg(
        F.avg(fx.html.has_usual_entities_only(F.regexp_replace("html", "<[^>]+>", " ")).cast("int"))).first()[0]
    assert share > 0.99


def test_phrases_are_found_in_one_pass_over_the_bytes(monkeypatch):
    """As ``in`` finds them: at both ends, never across two texts, in slices, null and empty texts."""
    import random

    import pyarrow as pa

    from qalathe.functions import phrases

    monkeypatch.setattr(phrases, "SLICE_BYTES", 37)
    draw = random.Random(5)
    texts = ["".join(draw.choice("abé ") for _ in range(draw.randrange(12))) for _ in range(400)] + [None, "", "a"]
    wanted = ["", "a", "ab", "ba", "aba", "é", "é a", "abab", "b a", "zz", " "]
    whole = pa.array(texts, pa.string())
    for array, plain in ((whole, texts), (whole.slice(7, 90), texts[7:97]), (pa.array([], pa.binary()), [])):
        got = phrases.phrases_found(array, [p.encode() for p in wanted])
        assert got.tolist() == [[t is not None and p in t for p in wanted] for t in plain]


def test_labels_by_plain_phrases_use_no_search_per_phrase(spark):
    rows = spark.createDataFrame([("x OOM and gpu",), ("",), (None,), ("K8S POD",)], "t string")
    found = rows.select(F.col("t"), fx.infra_components("t").alias("i"), fx.error_signatures("t").alias("e"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "nvidia" not in plan and "quota exceeded" not in plan
    assert [(r.i, r.e) for r in found.collect()] == [
        (["gpu"], ["OOMKilled", "GPUError"]), ([], []), ([], []), (["kubernetes"], [])]
