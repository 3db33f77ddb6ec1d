import re

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from talklake.functions import ids, markdown, terms, text, times

L = F.lit


def test_tags_notes_and_blanks(one):
    assert one(text.clean_segment(L("<font color='#fff'>Hello</font>"))) == "Hello"
    assert one(text.clean_segment(L("[Music]"))) == ""
    assert one(text.clean_segment(L("   a [x\ny] b [z]  "))) == "a [x\ny] b"
    assert one(text.clean_segment(L("a < b > c"))) == "a  c"
    assert one(text.squeeze(L("  Hello  \x1c  world \n"))) == "Hello world"


def test_keyword_text(one):
    assert one(text.keyword_text(L("See HTTPS://x.y/z?q=1 NOW, it's 5 o'clock\n!"))) == "see now it s o clock"


@pytest.mark.parametrize(
    "raw, slug",
    [
        ("IBM Technology", "ibm-technology"),
        ("Hello World!!! @#$", "hello-world"),
        ("--A  -  b--", "a-b"),
        ("", ""),
        ("x" * 49 + " yy", "x" * 49 + "-"),
    ],
)
def test_slug(one, raw, slug):
    assert one(text.slug(L(raw))) == slug


def test_has_words(one):
    nine = " ".join("a" * 9)
    assert one(text.has_words(L(nine), 10)) is False
    assert one(text.has_words(L(f"\n{nine} b"), 10)) is True
    assert one(text.has_words(L(""), 10)) is False


def test_words_and_pairs(one):
    tokens = terms.content_words(L("The red fox, a red-hot fox"), ["the"])
    assert one(terms.with_pairs(tokens)) == ["red", "fox", "red", "hot", "fox", "red fox", "fox red", "red hot", "hot fox"]
    assert one(terms.with_pairs(terms.content_words(L("x y"), []))) == []


def test_stop_phrase(one):
    assert one(terms.is_stop_phrase(L("really going"))) is True
    assert one(terms.is_stop_phrase(L("going home"))) is False
    assert len(terms.DOMAIN_STOP_WORDS) == 33
    assert "the" in terms.english_stop_words()


def test_point_id(one):
    assert one(ids.point_id(L("dQw4w9WgXcQ"))) == 6875601686285462142
    assert one(ids.point_id(L("abc123"))) == 7827605053139634307


def test_durations_and_clocks(one):
    for seconds, shown in [(0, "Unknown"), (-5, "Unknown"), (90, "1m 30s"), (3661, "1h 1m 1s"), (59, "0m 59s")]:
        assert one(times.duration_text(L(seconds))) == shown
    assert one(times.clock_text(L(0), L(5), L(3))) == "5:03"
    assert one(times.clock_text(L(1), L(5), L(3))) == "1:05:03"


def test_file_names(one):
    for number, shown in [(1, "001"), (42, "042"), (1234, "1234")]:
        assert one(markdown.file_name(L(number), L("IBM Technology"))) == f"TRANSCRIPT-{shown}-ibm-technology.md"


def test_days(one):
    assert one(times.day_text(times.parse_day(L("20260301")))) == "2026-03-01"
    assert one(times.parse_day(L("soon"))) is None
    assert one(times.parse_day(L("20261301"))) is None


def test_fill_never_reads_values(one):
    filled = markdown.fill("{a} %s {b}!", {"a": L("{b} %d"), "b": L("x")})
    assert one(filled) == "{b} %d %s x!"


SPACE_RUN = re.compile(r"\s+")


@settings(max_examples=40, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.text(alphabet="ab<>[]\n\r \t  \x1c\x85-Z9", max_size=30))
def test_cleaning_equals_plain_rules(one, raw):
    tagless = re.sub("<[^>]+>", "", raw.strip())
    expected = re.sub(r"\[.*?\]", "", tagless).strip()
    assert one(text.clean_segment(L(raw))) == expected
    assert one(text.squeeze(L(raw))) == SPACE_RUN.sub(" ", raw).strip()
