from pyspark.sql import functions as F

from docketry.functions import guards as G
from docketry.functions import statutes as S


def values(spark, rows, fn, kind="string"):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(rows)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("x")).alias("y")).collect()]


def test_statute_names(spark):
    assert values(spark, ["Under the Sales (Tax) Act, 1990.", "The  Sales Act", None], S.statute_key) == ["sales tax act 1990", "sales act", ""]
    assert values(spark, ["sales tax act 1990", "sales act", ""], S.yearless) == ["sales tax act", "sales act", ""]
    assert values(spark, ["means the Sales Act", "An Act further to amend the code", "Sales Act, 1990", None], S.is_clause_fragment) == [True, True, False, False]
    assert values(spark, ["%PDF-1.4 x", "", None, "Sales Act", "\x01\x02\x03abc"], S.is_garbage_name) == [True, True, True, False, True]
    assert values(spark, ["QUJDREVGR0hJSktMTU5PUFFSUw==", "act%20of", "sales.pdf", "Administrator - Act", "Sales Act, 1990", "", None], S.is_fragment_name) == [True, True, True, True, False, False, False]
    df = spark.createDataFrame([("  Sales   Act. ", 1990), ("Sales Act, 1990", 1991), ("Sales Act", None)], "n string, y int")
    assert [r[0] for r in df.select(S.cleaned_name(F.col("n"), F.col("y"))).collect()] == ["Sales Act, 1990", "Sales Act, 1990", "Sales Act"]


def test_numbers_and_mentions(spark):
    assert values(spark, ["0", "0A", "0E", "10", "", None], S.is_zero_section) == [True, True, False, False, False, False]
    assert values(spark, ["11.10.2018. 278 Volume XI", "2018.", "text 1.1.2000", None], S.starts_with_date) == [True, False, False, False]
    assert values(spark, ["", None, "6000", "12-A"], S.is_bogus_number) == [True, True, True, False]
    got = values(spark, ["ACT No. XIX of 1962", "act no 12 of 1999", "no act", None], S.act_number)
    assert [g and tuple(g) for g in got] == [(19, 1962), (12, 1999), None, None]
    assert values(spark, ["s.r.o. 12 (I) / 1999", "plain  text", None], lambda c: S.instrument_mention(c, "SRO")) == ["S.R.O. 12(I)/1999", "plain text", ""]
    assert values(spark, ["act no. iv of 1990"], lambda c: S.instrument_mention(c, "ACT_NO")) == ["Act No. IV of 1990"]
    assert values(spark, ["P. Cr. L.J.", None], S.reporter_code) == ["PCRLJ", ""]
    assert values(spark, ["http://x/?CaseName=1999sc12&b=1", "http://x/?CaseName=1999sc12z", None], S.case_code) == ["1999SC12", None, None]


def test_segments_and_schedules(spark):
    text = "Preamble\nSALES TAX ACT, 1990\n1. Short title.\nNOTIFICATION\nIt is notified."
    got = values(spark, [text, "plain", None], S.segments)
    assert [r["head"] for r in got[0]] == ["", "SALES TAX ACT, 1990", "NOTIFICATION"] and [r["head"] for r in got[1]] == [""] and got[2] is None
    got = values(spark, ["1. Body.\n\nTHE FIRST SCHEDULE\nrates", "no such part", None], S.peel_schedule)
    assert tuple(got[0]) == ("1. Body.", "THE FIRST SCHEDULE\nrates") and got[1]["schedule"] is None
    assert values(spark, ["0) a", "0.5 b", "0. c", "x", None], S.zero_class) == ["A", "B", "C", "unknown", "unknown"]
    assert values(spark, ["It may be called the Sales Tax Act, 1990 and shall", "none", None], S.called_titles) == [["Sales Tax Act, 1990"], [], None]


def test_payloads_and_queries(spark):
    rows = ['{"token": "x", "key": "a\\u0000b", "n": 3}', "{}", "no json", None]
    assert values(spark, rows, S.payload)[:2] == [{"key": "ab", "n": "3"}, {}]
    assert values(spark, ['{"long": "' + "y" * 30 + '"}'], lambda c: S.payload(c, 20))[0]["long"].startswith('{"_len":30')
    m = spark.createDataFrame([({"citation": "a", "court": " "},), ({"citation": "a", "court": "b"},), ({},), (None,)], "m map<string,string>")
    assert [r[0] for r in m.select(S.is_citation_only(F.col("m"))).collect()][:3] == [True, False, False]


def test_shingles(spark):
    words = " ".join(f"w{i}" for i in range(60))
    df = spark.createDataFrame([(words, words + " more"), (words, "other " * 60), ("short", words), (None, words)], "a string, b string")
    got = [r[0] for r in df.select(S.in_shingles(F.col("a"), F.col("b"))).collect()]
    assert tuple(got[0]) == (8, 8) and tuple(got[1]) == (0, 8) and got[2] is None and got[3] is None


def test_guards(spark):
    case = "IN THE LAHORE HIGH COURT\nA v. B \nDate of hearing: 1 May 1990\nMr. Khan for the petitioner.\nJUDGMENT\n" + "The appeal is allowed for reasons that follow. " * 130
    notes = "A v. B \nDate of hearing: 1 May 1990\nMr. Khan for the petitioner.\nOrder accordingly."
    login = "Update subscriber. Obtaining  subscription. I agree with the terms."
    assert values(spark, [case, notes, login, "", None], G.guard_flags) == [[], ["headnotes", "thin"], ["chrome", "no_structure", "thin"], ["empty"], ["empty"]]
    assert values(spark, [case, notes, None], G.is_headnote_only) == [False, True, False]
    df = spark.createDataFrame([(case, ["X"]), (case, []), (case, None), (notes, ["X"]), (None, ["X"])], "t string, j array<string>")
    assert [r[0] for r in df.select(G.is_full_ready(F.col("t"), F.col("j"))).collect()] == [True, False, False, False, False]
    assert values(spark, ["×\nCase Description\n\nCitation Name: x\nBody\nBookmark this case", "", None], G.strip_viewer_lines) == ["Body\nBookmark this case", "", ""]
    assert values(spark, ["x\nIN THE SUPREME COURT OF MARWAND\ny", "none", None], G.header_court) == ["Supreme Court Of Marwand", None, None]
    assert values(spark, ["A\n... Petitioner\nVersus\nThe State\n.. Respondent", "A\nVersus\nB", None], G.order_sheet_title) == ["A v. The State", None, None]
    page = spark.createDataFrame([("Sign in", "<input type='password'>"), ("Sign in", "<p>"), (case, "<input type='password'>")], "t string, h string")
    assert [r[0] for r in page.select(G.chrome_dominates(F.col("t"), F.col("h"))).collect()] == [True, False, False]
