"""Golden rows for column functions."""

import re
import unicodedata

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from railtide import vocab
from railtide.functions import cells, labels, rules, text, times, urls


def test_normalize_decorative_letters(column):
    styled = ["𝗔𝗰𝗮𝗱𝗲𝗺𝗶𝗰", "𝓐𝓬𝓪𝓭𝓮𝓶𝓲𝓬", "𝔸𝕔𝕒𝕕𝕖𝕞𝕚𝕔", "Ⓐⓒⓐⓓⓔⓜⓘⓒ", "Ａｃａｄｅｍｉｃ", "Acadêmic", "plain", None]
    assert column(styled, text.normalize_unicode) == ["Academic"] * 6 + ["plain", None]
    assert column(styled, lambda c: text.normalize_unicode(c, guard=False)) == ["Academic"] * 6 + ["plain", None]
    # U+1D455 is unassigned: the place of an italic h
    assert column(["\U0001d455"], lambda c: text.normalize_unicode(c, fill_holes=True)) == ["h"]


def test_normalize_equals_python(column):
    points = [chr(c) for c in list(range(0x20, 0x2FFF, 7)) + list(range(0x1D400, 0x1D7FF, 5))]
    values = ["x".join(points[i : i + 50]) for i in range(0, len(points), 50)]
    expected = ["".join(ch for ch in unicodedata.normalize("NFKD", v) if unicodedata.category(ch) != "Mn") for v in values]
    assert column(values, text.normalize_unicode) == expected


def test_casefold_after_normalize(column):
    assert column(["Straße", "WALANG PASOK"], lambda c: text.casefold(text.normalize_unicode(c))) == ["strasse", "walang pasok"]


def test_space_class_is_pythons(column):
    odd = [c for c in map(chr, range(0x3100)) if c.isspace()]
    assert column(["a" + c + "b" for c in odd], text.squash) == ["a b"] * len(odd)
    assert column([c + "a" + c for c in odd], text.strip) == ["a"] * len(odd)
    assert column(["a​b"], text.squash) == ["a​b"]


def test_caption_cleaner(column):
    raw = [
        "City · Shared with Public No classes tomorrow 🎉  See more…",
        "Walang   pasok\nbukas All reactions: 55 Like",
        "Update 12 reactions 4 comments", "Note 3 shares and more", "₱500 fare", None,
    ]
    assert column(raw, text.clean_caption) == [
        "No classes tomorrow", "Walang pasok bukas", "Update", "Note", "500 fare", ""]
    cleaned = column(raw, text.clean_caption)
    assert column(cleaned, text.clean_caption) == cleaned


def test_ocr_cleaner(column):
    raw = ["- ADVISORY -\r\nNo Classes\n\nno classes\n#hashtag\nab\nVisit www.x.ph\n• Stay safe •", "", "ab"]
    assert column(raw, text.clean_ocr) == ["ADVISORY No Classes Stay safe", "", ""]


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="aAbB cé", max_size=3), max_size=8))
def test_distinct_lines_keeps_first_spelling(column, lines):
    seen, kept = set(), []
    for line in lines:
        if line.lower() not in seen:
            seen.add(line.lower())
            kept.append(line)
    assert column([lines], text.distinct_lines, "array<string>") == [kept]


@settings(max_examples=30, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab \t\n ß", max_size=30), min_size=1, max_size=20))
def test_text_key_is_the_prefix_of_the_squashed_text(column, values):
    expected = [re.sub(r"\s+", " ", v).strip().casefold()[:8] or None for v in values]
    assert column(values, lambda c: text.text_key(c, chars=8)) == expected


def test_match_modes(column):
    values = ["the exam week", "for example", "bahay", "baha sa kalsada"]
    assert column(values, lambda c: text.contains_any(c, ["exam", "baha"])) == [True] * 4
    assert column(values, lambda c: text.contains_any(c, ["exam", "baha"], "word")) == [True, False, False, True]


def test_long_word_lists_agree_with_short_ones(column):
    values = ["no classes today", "nothing here", "code yellow advisory", None, ""]
    words = vocab.CLASS_SUSPENSION + vocab.TRAIN_DEGRADATION
    expected = [None if v is None else any(w in v for w in words) for v in values]
    assert column(values, lambda c: text.contains_any(c, words)) == expected


def test_keyword_gate(column):
    posts = [
        "Students, the Academic Calendar is here: dates of enrollment, classes and midterm examinations.",
        "Suspension of Number Coding today", "TRANSPORT STRIKE tomorrow", "U2 Concert at the dome", "Heavy rain and flooding",
        "Happy birthday!", "𝗪𝗔𝗟𝗔𝗡𝗚 𝗣𝗔𝗦𝗢𝗞 bukas", "exam results", "",
    ]
    assert column(posts, lambda c: rules.gate_category(rules.folded(c))) == [
        "academic", "lgu", "lgu", "lgu", "lgu", None, "academic", "academic", None]


def test_relevance(column):
    posts = ["Academic calendar out now", "Academic calendar: no classes Monday", "Delayed train at station", "Our line is closed", "Hello"]
    assert column(posts, lambda c: rules.is_relevant(rules.folded(c))) == [False, True, True, True, False]


def test_calendar_filter(column):
    posts = [
        "The Academic Calendar for A.Y. 2026-2027 is now available", "School calendar AY 2026-2027 https://bit.ly/x",
        "Draft academic calendar AY 2026-2027 released", "Academic calendar released", "AY 2026-2027 enrollment released",
    ]
    assert column(posts, lambda c: rules.is_calendar_release(rules.folded(c))) == [True, True, False, False, False]
    assert column(posts, lambda c: rules.has_calendar_hint(rules.folded(c))) == [True] * 5


def test_branch_filter(column):
    posts = [
        "all campuses (except olfu quezon city)", "all campuses except antipolo", "all campuses excluding for olfu antipolo",
        "antipolo, laguna", "laguna", "no classes",
    ]
    assert column(posts, rules.concerns_branch) == [True, False, False, True, False, False]


def test_event_codes_and_cancellation(spark):
    from railtide.operators.tagging import tag_events

    posts = [
        ("Transport Strike is Called Off", "TRANSPORT_STRIKE", True, "TRANSPORT_STRIKE"),
        ("Classes Resume Tomorrow", "RESUMPTION_CLASSES", True, "CLASS_SUSPENSION"),
        ("Walang Pasok Bukas", "CLASS_SUSPENSION", False, None),
        ("Suspension of Number Coding", "CIVIC_MAINTENANCE", False, None),
        ("Orientation cancelled", "FRESHMEN_ORIENTATION", True, "FRESHMEN_ORIENTATION"),
        ("Hello there", None, False, None),
    ]
    df = spark.createDataFrame([(i, p[0]) for i, p in enumerate(posts)], "i int, t string").withColumn("t", rules.folded(F.col("t")))
    got = tag_events(df, F.col("t")).orderBy("i").collect()
    assert [(r.event_code, r.is_cancellation, r.cancellation_target_code) for r in got] == [p[1:] for p in posts]
    petition = spark.createDataFrame([("walang pasok dahil sa korapsyon",), ("typhoon monitoring",)], "t string")
    assert [r.affects_ridership for r in tag_events(petition, F.col("t")).collect()] == [False, False]


def test_urls(column):
    base = "https://www.facebook.com"
    good = [base + "/QCGov/posts/123", base + "/photo/?fbid=12", base + "/share/p/abc", base + "/permalink.php?story_fbid=1"]
    bad = [
        base + "/people/x/posts/1", base + "/profile.php?id=3", base + "/x/posts/1?comment_id=3", base + "/reel/1", base + "/x/videos/1",
        base + "/QCGov", "https://facebook.com.evil.tld/posts/1", "", None,
    ]
    safe = column(good + bad, lambda c: F.coalesce(urls.is_safe_post_url(c), F.lit(False)))
    assert safe == [True] * len(good) + [False] * len(bad)
    assert column([bad[6]], lambda c: urls.is_safe_post_url(c, strict_host=False)) == [True]
    photos = [base + "/photo/?fbid=1&set=a", base + "/photo/?fbid=2&set=a", base + "/Photo/?set=a&fbid=1"]
    kept = column(photos, urls.url_key)
    assert kept[0] == kept[2] != kept[1]
    assert len(set(column(photos, lambda c: urls.url_key(c, ())))) == 1
    assert column(["http://a/b?x=1&y=2", "http://a/b?__cft__=1"], urls.clean_url) == ["http://a/b?x=1", "http://a/b"]


def test_cells(column):
    values = ["1,200", " 900 ", "-", "", "12.0", "12.5", "-4", "abc", "1d", "1e3", None]
    assert column(values, cells.optional_int) == [1200, 900, None, None, 12, None, None, None, None, 1000, None]
    assert column(values, cells.optional_int_reject) == [None] * 5 + ["fractional", "negative"] + [None] * 4
    assert column(["1,200", "7"], lambda c: cells.optional_int(c, strip_commas=False)) == [None, 7]
    assert column(["0.5", "1.2", "x", None], cells.unit_weight_reject) == [None, "out_of_range", "not_a_number", "not_a_number"]
    assert column(["2.5", "-1", "x", "", None], cells.optional_float_reject) == [None, "negative", "not_a_number", None, None]
    assert column([" a ", " ", None, "abcd"], lambda c: cells.required_text_reject(c, 3)) == [None, "blank", "missing", "too_long"]


def test_period_labels(column):
    values = ["7-9am (AM Peak)", "7-9am off peak", "5-7PM\n peak", "Daily  total", "9am-5pm", None]
    assert column(values, labels.period_label) == [
        vocab.AM_PEAK, vocab.AM_PEAK, vocab.PM_PEAK, vocab.DAILY_TOTAL, None, None]
    values = ["9am-5pm", "0700-0900", "06:00-07:00", "Subtotal (Peak)", "Total (Peak + Off Peak)", "note"]
    labelled = column(values, labels.row_period_label)
    assert labelled == [vocab.MIDDAY_OFF_PEAK, vocab.AM_PEAK, "06:00-07:00", vocab.PEAK_TOTAL, vocab.MONTHLY_TOTAL, None]
    assert column(labelled[:5] + ["other"], labels.period_rank) == [4, 1, 460, 20, 22, 10000]


def test_identifiers_and_dates(column):
    assert column(["Betty Go", " V. Mapa ", "Araneta\nCubao", "Marikina-Pasiq"], labels.identifier) == [
        "betty_go_belmonte", "v_mapa", "araneta_center_cubao", "marikina_pasig"]
    days = ["1-Jan", "February 3", "2023-01-05 00:00:00", "1/15/2023", "29-Feb", "5", "x", "31-Sept"]
    got = column(days, lambda c: labels.service_date(c, F.lit(2023)).cast("string"))
    assert got == ["2023-01-01", "2023-02-03", "2023-01-05", "2023-01-15", None, None, None, None]
    assert column(["29-Feb"], lambda c: labels.service_date(c, F.lit(2024)).cast("string")) == ["2024-02-29"]
    assert column(["AFCS_January 2024", "afcs-sept-2023", "AFCS 2024"], lambda c: F.concat_ws("/", labels.file_month(c), labels.file_year(c))) == ["1/2024", "9/2023", ""]
    assert column(["University of Santo Tomas", "New Era College 2"], labels.acronym) == ["UST", "NEC"]


def test_times(column):
    assert column(["2026-08-13", "2026-08-13 to 2026-08-15", "n/a", "soon", "2026-02-31", None], times.pretty_event_date) == [
        "August 13, 2026", "August 13, 2026 to August 15, 2026", "Not specified", "soon", "2026-02-31", "Not specified"]
    assert column(["2026-08-13T14:30:00.5+00:00", "later", ""], times.pretty_timestamp) == ["August 13, 2026, 02:30 PM", "later", "N/A"]
    assert column(["2026-06-18T08:00", "2026-06-18T08:00Z", "2026-06-18T08:00+00:00"], times.with_offset) == [
        "2026-06-18T08:00+08:00", "2026-06-18T08:00Z", "2026-06-18T08:00+00:00"]
    now = F.lit("2026-06-18 12:00:00").cast("timestamp")
    seen = ["2026-06-18 11:15:00", "2026-06-18 11:14:54", None, "junk"]
    assert column(seen, lambda c: times.is_stale(now, F.try_to_timestamp(c))) == [False, True, True, True]
    ages = column(["2026-06-17T12:00:00Z", "2026-06-19T12:00:00Z", "bad"], lambda c: times.age_days(now, times.post_time(c, F.lit(1.0))))
    assert ages == [1.0, 0.0, None]
    assert column(["2026-06-04", "2026-06-03 to 2026-07-01", "2026-02-31", "x"], lambda c: times.is_past_event(c, now)) == [False, True, False, False]


def test_levels_and_categories(column):
    assert column([7.49, 7.5, 15.0, 30.0, 30.01, None], rules.rainfall_level, "double") == ["None", "Yellow", "Orange", "Orange", "Red", None]
    assert column(["academic", "lgu", "pagasa", "academic_calendar", "otherThing", None], rules.category_label) == [
        "Academic", "LGU", "PAGASA", "Academic Calendar", "Otherthing", "N/A"]
    assert column(["academic", "academic_calendar", "ACAD", "lgu"], rules.category_code) == ["acad", "acad", "acad", "lgu"]
    assert column(["external_acad_0012", "a-b-7", "x_1", "external_acad_x"], rules.id_number) == [12, 7, 999999, 999999]
    names = ["City PIO", "State University", "Weather PAGASA", "Other"]
    assert column(names, lambda c: rules.source_category(c, F.lit(None).cast("string"))) == ["lgu", "academic", "pagasa", "academic"]


def test_python_batches_are_bounded_by_bytes(spark):
    from railtide.session import prepare

    prepare(spark)

    @F.pandas_udf("bigint")
    def held(texts):
        return texts.map(lambda _: total) if (total := int(texts.str.len().sum())) else texts

    wide = spark.range(0, 300, 1, 1).select(F.repeat(F.lit("x"), 100_000).alias("t"))
    # far fewer rows than a batch may have, but 30 MB of text
    assert wide.agg(F.max(held("t"))).first()[0] < 6_000_000
