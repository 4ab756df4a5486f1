import datetime as dt

from pyspark.sql import functions as F

from docketry.functions import dates as D
from docketry.functions import legal as L
from docketry.functions import text as T
from docketry.functions import urls as U


def values(spark, rows, fn, kind="string"):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(rows)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("x")).alias("y")).collect()]


def test_text(spark):
    assert values(spark, ["a   b\n", None, ""], T.collapse) == ["a b", None, ""]
    a, b, c = values(spark, ["a  b", "a b ", "ab"], T.canonical_text_hash)
    assert a == b != c
    assert values(spark, ["Act, 2026", "ACT 2026", None], T.name_key) == ["act2026", "act2026", ""]
    assert values(spark, ["x" * 199, "x" * 200, None], T.text_is_thin) == [True, False, True]
    assert values(spark, ["Supreme Court (Peshawar)", "  ", None], T.slug) == ["supreme-court-peshawar", "", None]
    long = "k" * 600
    assert [len(x) for x in values(spark, [long, "short"], T.fit_key)] == [500, 5]
    assert values(spark, ["one two three", None], lambda c: T.summary(c, 2)) == ["one two", None]
    assert values(spark, ["O R D E R of the court", None], T.collapse_letter_spaced) == ["ORDER of the court", None]


def test_quality(spark):
    prose = "The officer in charge shall report the matter to the board without delay."
    moji = "The Ã©tat of Â§ 4 and â€œthe" * 3
    assert values(spark, [prose, moji, "12345 67.8 " * 20, "Tariff heading " + "1234 " * 15, "short", None, "���" + prose], T.fails_ocr_quality) == [False, True, True, False, False, False, True]
    schedule = "12 34.5 67 89.1 " * 8
    assert values(spark, ["Rescheduled " + schedule, "Customs duty " + schedule, "Heading No " + schedule], T.is_schedule) == [False, True, True]
    assert values(spark, [prose * 2, "a b c d e f g " * 20, "عدالت نے قرار دیا کہ " * 10, "", None], T.is_garbled) == [False, True, False, False, False]
    rows = [prose, "\x00\x01\x02" * 20, "", None, "\u00ff\u00d8\u00ff\u00e0 short", "\u0089PNG and " + prose, prose + " JFIF", "abcde JFIF \u00ff\u00fe\u00ff", "\ue012\ue044 \ue100", "\u00e9" * 9 + "ab"]
    assert values(spark, rows, T.is_binary_garbage) == [False, True, False, False, True, True, False, True, False, True]
    assert values(spark, [prose, "short words", "a b c d e f g " * 20, "\ue012\ue044\ue100\ue101\ue102\ue103\ue104\ue105", "عدالت", None], T.has_readable_words) == [True, False, False, True, False, False]
    assert values(spark, ["عدالت نے قرار", "عدالت", "\ue012" * 8, prose, None], T.is_arabic_script) == [True, False, True, False, False]
    assert values(spark, ["a ???? b", "a ??? b", None], T.has_mojibake_run) == [True, False, False]
    assert values(spark, ["عدالت", "abc", "", None], T.arabic_share) == [1.0, 0.0, 0.0, 0.0]


def test_secrets(spark):
    rows = ["password = hunter22x rest", "api_key: abcdef123", "Authorization: Bearer abc.def", "plain text", None, "AKIA" + "A" * 16, "Set-Cookie: a=b", "xsrf-token: abcdef12", "ASP.NET_SessionId=abc123def", "authtoken = 1234567", "sgai-" + "a1-" * 6, "sid: 12345", "inside: 1234567"]
    assert values(spark, rows, T.contains_secret) == [True, True, True, False, False, True, True, True, True, True, True, False, False]
    got = values(spark, rows, T.scrub_secrets)
    assert got[0] == "password = [REDACTED] rest" and got[3] == "plain text" and got[4] is None and got[5] == "[REDACTED]" and got[6] == "Set-Cookie: [REDACTED]"
    assert got[2] == "Authorization: [REDACTED]" and got[10] == "[REDACTED]"


def test_snippet(spark):
    text = "x" * 150 + " needle " + "y" * 400
    got = values(spark, [text, "needle at once", "no such", None], lambda c: T.snippet(c, ["needle"]))
    assert got[0].startswith("…") and "needle" in got[0] and got[0].endswith("…")
    assert got[1:] == ["needle at once", "no such", None]


def test_dates(spark):
    text = "on 5 March 2019, then March 7, 2019 and 08.03.2019, 2019-03-09; 31.02.2019 is none, 1 May 1800 too early, 5 March 2019 again"
    assert values(spark, [text, "", None], D.find_dates) == [[dt.date(2019, 3, d) for d in (5, 7, 8, 9)], [], None]


def test_urls(spark):
    rows = ["https://www.Law.example:8080/a?b", "law.example/x", "http://user@h.example/|label", "", None]
    assert values(spark, rows, U.source_host) == ["law.example", "law.example", "h.example", "(none)", "(none)"]
    allow = ["law.example"]
    rows = ["https://law.example/a", "https://a.law.example/", "ftp://law.example/", "https://u@law.example/", "https://law.example:8080/", "http://10.0.0.1/", "https://evil.example/", None]
    assert values(spark, rows, lambda c: U.url_violation(c, allow)) == [None, None, "scheme", "userinfo", "port", "private", "host", "scheme"]
    assert values(spark, ["a.PDF?x=1", "a.html", None], U.looks_like_pdf) == [True, False, False]
    assert values(spark, [200, 404, 503, None], U.status_action, "int") == ["ok", "retire", "defer", "defer"]
    assert values(spark, [0, 1, 2, 7, 50], U.backoff_seconds, "int") == [300, 300, 600, 19200, 19200]
    assert values(spark, [b"xx%PDF-1.4", b"<html>", None], U.has_pdf_signature, "binary") == [True, False, None]


def test_html(spark):
    html = "<html><nav>Home</nav><script>if(a<b)</script><p>One &amp; two<br>three</p><!-- no --><p>four</p></html>"
    assert values(spark, [html, "", None], U.html_to_text) == ["One & two\nthree\nfour", "", ""]
    links = values(spark, ['<a class="x" href="/case/1">One <b>case</b></a><a name="y">no</a>', None], U.page_links)
    assert [tuple(x) for x in links[0]] == [("/case/1", "One case")] and links[1] is None


def test_legal(spark):
    assert values(spark, [0, 1, 2, 4, 9, None], L.bench_type, "int") == [None, "single", "division", "full", "larger", None]
    assert values(spark, ["Mr. Justice ALI BAIG, J", "Hon'ble Justice Omar Khan, C.J.", "", None], L.judge_name) == ["Ali Baig", "Omar Khan", "", None]
    kinds = {
        "W.P. No. 12 of 1999": "constitutional_petition", "Cr.A. No. 3 of 2001": "criminal_appeal", "Bail Application 3": "bail", "Crl. Misc. No. 12-B/2011": "bail", "Murder Reference No. 4 of 2010": "criminal_reference",
        "M.R. No. 8 of 2012": "criminal_reference", "I.T.R. No. 3 of 2001": "tax_reference", "Sales Tax Reference 9": "tax_reference", "Execution Petition 4": "execution", "Transfer Application No. 2": "transfer", "C.P.L.A. No. 4": "leave_to_appeal",
        "I.C.A. 12 of 2004": "intra_court_appeal", "R.F.A. No. 9 of 1990": "civil_appeal", "Civil Revision 77": "civil_revision", "Cr.R. No. 5": "criminal_revision", "C.P. No. 5 of 2001": "constitutional_petition", "under section 12 C.P.C.": "other",
        "Criminal Misc. 7": "criminal_miscellaneous", "C.M.A. No. 7": "civil_miscellaneous", "Suit No. 3": "civil_suit", "Habeas petition": "habeas_corpus", "Review Petition 3": "review", "Contempt 4": "contempt", "": "other",
    }
    assert values(spark, [*kinds, None], L.proceeding_type) == [*kinds.values(), "other"]
    assert values(spark, ["Civil suit heard", None], lambda c: L.proceeding_type(F.lit("No. 4"), c)) == ["civil_suit", "other"]
    said = {
        "That view stands over-ruled and the rule is no longer good law": "overruled", "It was per incuriam": "per_incuriam", "which distinguishes the judgment": "distinguished", "can be distinguished on facts": "distinguished", "We declined to follow it": "not_followed",
        "we respectfully dissent": "dissented_from", "affirmed in appeal and followed": "followed", "affirmed in appeal": "approved", "relying upon the case": "relied_upon", "placed reliance on": "relied_upon", "reference may be made to": "referred", "unrelied": None,
    }
    assert [g and g["label"] for g in values(spark, list(said), L.best_treatment)] == list(said.values())
    got = values(spark, ["it was overruled and relied upon", "relied upon", "nothing", None], L.best_treatment)
    assert [g and g["label"] for g in got] == ["overruled", "relied_upon", None, None]
    assert values(spark, ["12-A", "1947", "", "x", None], L.section_integer) == [12, 1947, None, None, None]
    assert values(spark, ["1947", "194", None], L.is_year_section) == [True, False, False]
    assert values(spark, [" 12-a. ", "7 B", "", None], L.section_token) == ["12-A", "7B", "", None]
    day = spark.createDataFrame([(dt.date(2019, 3, 5), "heard on 5 March 2019"), (dt.date(2019, 3, 6), "heard on 5 March 2019"), (None, "5 March 2019"), (dt.date(2019, 3, 5), None)], "d date, t string")
    assert [r[0] for r in day.select(D.date_in_text(F.col("d"), F.col("t"))).collect()] == [True, False, False, False]
    assert values(spark, [b"\xff\xd8\xff\xe0", b"\x89PNG\r\n", b"GIF89a", b"text", None], U.is_image_bytes, "binary") == [True, True, True, False, None]
