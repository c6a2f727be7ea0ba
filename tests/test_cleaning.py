import re

import pytest
from pyspark.sql import functions as F

from lexmill.functions.cleaning import (
    ARTICLE_RULES,
    REVIEW_LITERALS,
    clean_article,
    collapse_spaces,
    java_pattern,
    literal_prefix,
    review_words,
    split_words,
    strip_review_marks,
    text_or_token,
)
from lexmill.functions.hashing import unit_hash
from lexmill.views import ARTICLE_MARKS


def column(spark, texts, expression):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    return [r.out for r in rows.select("i", expression(F.col("text")).alias("out")).orderBy("i").collect()]


def test_review_marks_are_removed_in_order(spark):
    texts = ["\n應我該 好，>:<還是^^\n", "應該 在 > >< <a  b\t", "應的該x", "", "\n\n", "a\nb", "我應該他", "><>:<"]
    out = column(spark, texts, lambda t: collapse_spaces(strip_review_marks(t)))
    assert out[:5] == ["應該 好是^^", "> <a b", "x", "", ""]
    plain = []
    for text in texts:
        text = text.strip("\n")
        for literal in REVIEW_LITERALS:
            text = text.replace(literal, "")
        plain.append(" ".join(text.split()))
    assert out == plain


def test_only_newlines_at_the_ends_are_trimmed(spark):
    assert column(spark, ["\n\n a\nb \n", "a", " \n", "b\n"], strip_review_marks) == [" a\nb ", "a", " ", "b"]


def test_unicode_spaces_collapse(spark):
    assert column(spark, ["a　b  c\x85d ", "\r\n x \x1c y"], collapse_spaces) == ["a b c d", "x y"]


def test_single_space_split_keeps_empty_words(spark):
    assert column(spark, ["", "a  b ", " "], split_words) == [[""], ["a", "", "b", ""], ["", ""]]
    assert column(spark, [""], review_words) == [[""]]


def test_missing_text_is_a_word(spark):
    assert column(spark, [None, "x"], text_or_token) == ["nan", "x"]


def plain_clean(text):
    for rule in ARTICLE_RULES:
        text = re.sub(rule, "", text)
    return text


ARTICLES = [
    *ARTICLE_MARKS,
    *["one\n" + m + "\nlast" for m in ARTICLE_MARKS],
    "a來源：x\ry\nz",
    "地址：p q\x85r\ns",
    "http://a　b http\x1cc",
    "圖／a提供b\n提供c",
    "ht(x)tp://y z",
    "ht\ntp://y z",
    "【a\n】（b\n）",
    "",
]


def test_article_rules_match_their_definition(spark):
    assert column(spark, ARTICLES, clean_article) == [plain_clean(t) for t in ARTICLES]


def test_cut_to_line_end_before_and_to_document_end_after_the_newline_rule(spark):
    assert column(spark, ["a來源：b\nc", "a地址：b\nc"], clean_article) == ["ac", "a"]


@pytest.mark.parametrize(
    ("rule", "prefix"),
    [
        (r"延伸閱讀.+", "延伸閱讀"),
        (r"\((.*?)\)", "("),
        (r"\n", "\n"),
        (r"http\S+", "http"),
        (r"ab*c", "a"),
        (r"ab?", "a"),
        (r"ab{0,2}c", "a"),
        (r"a|b", ""),
        (r"(a)b", ""),
        (r"\d+x", ""),
        (r"[ab]c", ""),
        (r"ab+", "ab"),
    ],
)
def test_literal_prefix(rule, prefix):
    assert literal_prefix(rule) == prefix


def test_java_pattern_leaves_other_escapes():
    assert java_pattern(r"a\S\\S\d\(") == r"(?dU)a[^\s\x1c-\x1f]\\S\d\("


def test_user_rules(spark):
    out = column(spark, ["xay1", "b22c", "zz"], lambda t: clean_article(t, [r"a|b", r"\d+", "z"]))
    assert out == ["xy", "c", ""]


def test_unit_hash_is_a_fair_share_and_depends_on_keys_only(spark):
    ids = spark.range(20_000)
    share = ids.where(unit_hash(7, "id") < 0.1).count() / 20_000
    assert abs(share - 0.1) < 0.01
    one = ids.repartition(1).select(F.sum(unit_hash(7, "id"))).first()[0]
    many = ids.repartition(7).select(F.sum(unit_hash(7, "id"))).first()[0]
    assert one == pytest.approx(many)
    assert ids.where((unit_hash(7, "id") < 0.1) & (unit_hash(7, "id") >= 0.1)).isEmpty()


def test_a_literal_rule_takes_no_regex(spark):
    rules = [r"\n", "文．", "a+"]
    df = spark.createDataFrame([("a文\n．b\n\na文．",), (None,), ("",)], "t string").select(clean_article(F.col("t"), rules).alias("t"))
    assert sorted(str(r.t) for r in df.collect()) == ["", "None", "b"]
    assert df._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace") == 1
