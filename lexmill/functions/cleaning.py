"""Ordered text cleaning rules and tokenisation."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Deleted from a review, in this order, before its words are counted.
REVIEW_LITERALS = ["，", ":", "。", "~", "的", "和", "還", "在", "還是", "應該", "我", "你", "他", "妳", "><"]

# Patterns deleted from an article, in this order. The newline rule stands in the
# middle, so the rules above it stop at the end of a line and the rules below it do not.
ARTICLE_RULES = [
    r"延伸閱讀.+",
    r"《原文刊登於.+",
    r"來源：.+",
    r"來源：文．",
    r"文．",
    r"看這裡>>.+",
    r"看這裡>>.+",
    r"本文摘自.+",
    r"【(.*?)】",
    r"\((.*?)\)",
    r"\n",
    r"http\S+",
    r"圖／.+提供",
    r"圖／翻攝自臉書社團",
    r"（(.*?)）",
    r"《本文作者.+",
    r"地址：.+",
]

# Java's classes for white space as the rules mean it: any Unicode white space, and the four separators
# U+001C to U+001F, which Java counts as control characters.
_SPACES = {"s": r"[\s\x1c-\x1f]", "S": r"[^\s\x1c-\x1f]"}


def java_pattern(rule: str) -> str:
    """A rule for ``regexp_replace``: only ``\\n`` ends a line, and white space is Unicode white space."""
    return "(?dU)" + re.sub(r"\\(.)", lambda m: _SPACES.get(m[1], m[0]), rule, flags=re.DOTALL)


def text_or_token(text: Column, null_token: str = "nan") -> Column:
    """P5: a missing text acts as one fixed word."""
    return F.coalesce(text, F.lit(null_token))


def strip_review_marks(text: Column, literals: Sequence[str] = REVIEW_LITERALS) -> Column:
    """Drop newlines at both ends, then delete each literal in turn.

    Trimming given characters walks over the whole text, so texts without a newline at an end skip it.
    """
    at_an_end = text.startswith("\n") | text.endswith("\n")
    trimmed = F.when(at_an_end, F.trim(text, F.lit("\n"))).otherwise(text)
    return reduce(lambda t, literal: F.replace(t, F.lit(literal), F.lit("")), literals, trimmed)


def collapse_spaces(text: Column) -> Column:
    """Every run of white space becomes one space; none at the ends."""
    return F.trim(F.regexp_replace(text, java_pattern(r"\s+"), " "))


def split_words(text: Column, most: int = -1) -> Column:
    """Split at every single space; empty words are kept. With ``most``, the last of so many items is the rest of the text."""
    return F.split(text, " ", most)


def review_words(text: Column) -> Column:
    """T1, T2 and T3 together: the words whose frequencies are counted."""
    return split_words(collapse_spaces(strip_review_marks(text)))


def literal_prefix(rule: str) -> str:
    """The literal text that every match of a pattern starts with; empty if there is none to tell."""
    prefix, i = "", 0
    while i < len(rule):
        char = rule[i]
        if char == "\\":
            escaped = rule[i + 1]
            if escaped.isalnum() and escaped != "n":
                break
            char, i = "\n" if escaped == "n" else escaped, i + 1
        elif char in "*?{|":
            # What stands before it may be missing, and an alternative may start with anything.
            return "" if char == "|" else prefix[:-1]
        elif char in ".^$+[](":
            break
        prefix, i = prefix + char, i + 1
    return "" if "|" in rule else prefix


def clean_article(text: Column, rules: Sequence[str] = ARTICLE_RULES) -> Column:
    """T4: delete each rule's matches in turn.

    A rule that is a literal is deleted as one. A byte search for the literal prefix of another keeps the regex, and its copy of the text,
    away from the texts without a match. The one-element ``transform`` binds the text so far to a variable: written out
    three times per rule, the expression would grow with the power of the number of rules.
    """

    def delete(rule: str, current: Column) -> Column:
        prefix = literal_prefix(rule)
        if prefix and prefix == rule.replace(r"\n", "\n"):
            return F.replace(current, F.lit(prefix), F.lit(""))
        deleted = F.regexp_replace(current, java_pattern(rule), "")
        return F.when(current.contains(prefix), deleted).otherwise(current) if prefix else deleted

    return reduce(lambda t, rule: F.get(F.transform(F.array(t), lambda x: delete(rule, x)), 0), rules, text)


def clean_articles(articles: DataFrame, text: str = "maintext") -> DataFrame:
    """T4 on the text column of articles."""
    return articles.withColumn(text, clean_article(F.col(text)))
