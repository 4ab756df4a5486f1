from pyspark.sql import functions as F

from docketry.functions import volumes as V

BODY = "The appeal was heard and the order of the court below was set aside with costs."
VOLUME = f"""TABLE OF CASES
Ali Baig v. The State ...... 12
Omar Khan v. Sana Noor ..... 40

Ali Baig v. The State

{BODY}

Omar Khan versus Sana Noor

{BODY} {BODY}

Ali Baig v. The State

{BODY} It was so ordered.
"""


def test_volume():
    assert V.cases_listed_of(VOLUME) == [{"title": "Ali Baig v. The State", "page": 12}, {"title": "Omar Khan v. Sana Noor", "page": 40}]
    got = V.split_volume_of(VOLUME)
    assert [(c["petitioner"], c["respondent"]) for c in got] == [("Omar Khan", "Sana Noor"), ("Ali Baig", "The State")]
    assert got[1]["body"].endswith("so ordered.")
    assert V.split_volume_of(None) == V.split_volume_of("") == V.split_volume_of("no caption") == []


def test_contents():
    contents = "1. Short title ....... 3\n2. Definitions .... 4\n3. Omitted ........ 5\n4-A. Appeals"
    assert [(e["number"], e["page"], e["omitted"]) for e in V.contents_of(contents)] == [("1", 3, False), ("2", 4, False), ("3", 5, True), ("4-A", None, False)]
    body = "1. Short title. This Act may be called the Example Act and extends to the whole.\n2. In\n4-A. Appeals lie to the board within thirty days of the order."
    assert [(e["number"], e["found"], e["thin"]) for e in V.check_contents_of(contents, body)] == [("1", True, False), ("2", True, True), ("3", False, None), ("4-A", True, False)]
    assert V.check_contents_of(None, body) == []


def test_columns(spark):
    text = "Lahore High Court\nAli Baig v. The State\nW.P. No. 12-P of 1999\nDate of hearing: 5 March 1999\nJUDGMENT\nOmar Khan v. Sana Noor was cited."
    df = spark.createDataFrame([(1, text), (2, None), (3, "")], "i int, t string")
    got = {r["i"]: r for r in df.select("i", V.case_head(F.col("t")).alias("h"), V.caption(F.col("t")).alias("c")).collect()}
    assert tuple(got[1]["h"]) == ("Ali Baig v. The State", "W.P. No. 12-P of 1999", "5 March 1999") and "JUDGMENT" not in got[1]["c"]
    assert tuple(got[2]["h"]) == (None, None, None)
    dirty = spark.createDataFrame([("\ufeff\u00a0a   b\r\n\r\n\r\n\r\nc\u200b d ",), (None,)], "t string")
    assert [r[0] for r in dirty.select(V.clean_text(F.col("t"))).collect()] == ["a b\n\nc d", None]
    pair = spark.createDataFrame([("short", "x" * 300), ("y" * 400, "x" * 300), (None, "z"), ("a", None)], "a string, b string")
    assert [r[0][0] for r in pair.select(V.best_body(F.col("a"), F.col("b"))).collect()] == ["x", "y", "z", "a"]
    assert V.split_volumes(spark.createDataFrame([("v", VOLUME), ("n", None)], "id string, t string"), "id", "t").count() == 2
    assert [e["number"] for e in spark.createDataFrame([("1. Title ..... 3",)], "t string").select(V.contents_entries(F.col("t")).alias("e")).first()["e"]] == ["1"]
