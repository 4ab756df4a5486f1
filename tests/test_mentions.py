from pyspark.sql import functions as F

from docketry.functions import lines as N
from docketry.functions import spans as S


def test_citation_spans():
    text = "See PLD 1974 SC 1223 and P.L.D. 1975 Lah. 9; 1999 CLCN 12, 1999 CLC 12, 2001 P Cr. L J 77; 2025 SHC KHI 608; 1930 CLC 4."
    got = S.citation_spans_of(text)
    assert [(c["family"], c["year"], c["court"], c["page"]) for c in got] == [("PLD", 1974, "SC", 1223), ("PLD", 1975, "LAH", 9), ("CLCN", 1999, "", 12), ("CLC", 1999, "", 12), ("PCrLJ", 2001, "", 77), ("NEUTRAL", 2025, "SHC KHI", 608)]
    assert all(text[c["start"] : c["end"]] == c["raw"] for c in got)
    assert S.citation_spans_of(None) == S.citation_spans_of("") == []


def test_sections_are_bound_to_statutes():
    text = "The Excise Duty Act, 1958 applies. Under section 5(2) and section 9 of the Town Planning (Control) Act, 2001, it is so. " + "x " * 150 + "section 7 stands alone."
    got = [(r["number"], r["statute"], r["bound_by"]) for r in S.statute_spans_of(text)]
    assert got == [("5(2)", "The Excise Duty Act, 1958", "preceding"), ("9", "Town Planning (Control) Act, 2001", "following"), ("7", None, "none")]


def test_amendments():
    text = "In section 5 of the Excise Duty Act, 1958, the words shall be substituted; section 6 shall be omitted. Nothing is hereby repealed."
    assert [(a["operation"], a["number"]) for a in S.amendments_of(text)] == [("substitute", "5"), ("omit", "6")]
    assert S.amendments_of(None) == []


def test_windows(spark):
    text = "First one. It cites PLD 1974 SC 1223 with approval. Last one."
    start = text.index("PLD")
    df = spark.createDataFrame([(text, start, start + 16), (None, 0, 1)], "t string, a int, b int")
    got = df.select(S.sentence(F.col("t"), F.col("a"), F.col("b")), S.passage(F.col("t"), F.col("a"), F.col("b"), 20)).collect()
    assert got[0][0] == "It cites PLD 1974 SC 1223 with approval." and "PLD 1974 SC 1223" in got[0][1] and got[1][1] is None
    assert [c["family"] for c in spark.createDataFrame([(text,), (None,)], "t string").select(S.citation_spans(F.col("t")).alias("c")).first()["c"]] == ["PLD"]


def column(spark, rows, fn, kind="string"):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(rows)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("x")).alias("y")).collect()]


def test_mojibake_and_tails(spark):
    body = "The petition is allowed in these terms.\nSd/-"
    plain = "The petition is allowed in these terms."
    cases = {
        body: "none", body + "\n????? ???? ??\n\n????": "headnote", "The ???? petition was heard\n" + body: "body", body + "\nThe ???? order of the court": "body", body + "\n????\n12": "body", body + "\nعدالت نے\n????": "headnote",
        plain + "\n????": "headnote", plain + "\n????\n" + plain: "body", "????\n????": "headnote", body + "\n???? appearance": "body", body + "\n???? 1234567890123456": "body", "": "none",
    }
    assert column(spark, [*cases, None], N.mojibake_class) == [*cases.values(), "none"]
    rows = [body + "\n????? ????\n\n", plain + "\n????\n", body + "\n????\nThe ???? order of the court\n????", plain, "", None]
    assert column(spark, rows, N.strip_lost_tail) == [body + "\n", plain + "\n", body + "\nThe ???? order of the court", plain, "", ""]
    notice = "It is ordered so.\nA copy is forwarded to:\n1. The Secretary, Law Department.\n2. Director, Archives."
    other = "A copy is forwarded to the parties who shall appear.\nThe case goes on."
    assert column(spark, [notice, other, "", None], N.strip_distribution) == ["It is ordered so.", other, "", None]


def test_numerals_and_runs(spark):
    assert column(spark, ["XIV", "iv", "12", "IIII", "abc", "", "0", None], N.numeral) == [14, 4, 12, 4, None, None, 0, None]
    assert N.rising_end_of([3, 1, 2, 9, 4, 5]) == 5 and N.rising_end_of([]) == 0 and N.rising_end_of([None, 7]) == 7
    assert N.similarity_of("a  b", "a b") == 1.0 and N.similarity_of(None, "x") == 0.0
    many = "Before: " + ", ".join(f"Justice Name{chr(65 + i)} Khan" for i in range(9))
    got = column(spark, ["IN THE COURT\nCoram: Mr. Justice Ali Baig and Omar Khan, JJ\nORDER", "x" * 9000 + "\n" + many, "no line", None], N.bench)
    assert got[0] == ["Ali Baig", "Omar Khan"] and len(got[1]) == 9 and got[2:] == [[], []]


def test_titles(spark):
    rows = [("Excise Duty Act, 1958", "The Excise Duty Act 1958"), ("Excise Duty Act, 1958", "Excise Duty Act, 1960"), ("Excise Duty Act, 1958", "Town Planning Act, 1958"), ("The Act", "Town Planning Act"), (None, "x y")]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(rows)], "i int, a string, b string").orderBy("i")
    assert [r[0] for r in df.select(N.title_relation(F.col("a"), F.col("b"))).collect()][:4] == ["same", "year_differs", "different", "unknown"]
    assert column(spark, ["1lyas Ajma1 of 1958", "11yas", None], N.ocr_name) == ["Ilyas Ajmal of 1958", "Ilyas", None]
    got = spark.createDataFrame([("a b", "a  b"), (None, "x")], "a string, b string").select(N.similarity(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in got] == [1.0, 0.0]


def test_amendment_clauses_of_both_tables(spark, tmp_path):
    from docketry.plans.catalog import CORE

    text = "In the Sales Act, 1990, section 5 shall be substituted; section 6 shall be omitted.\nSection 5 shall be substituted."
    spark.createDataFrame([("i1", text), ("i2", "nothing here"), ("i3", None)], "id string, full_text string").write.parquet(f"{tmp_path}/instrument.parquet")
    spark.createDataFrame([("v1", "Section 9 is hereby repealed.")], "id string, section_text string").write.parquet(f"{tmp_path}/statute_section_version.parquet")
    got = {(r["source_table"], r["id"], r["operation"], r["number"]) for r in CORE.queries["amendment_clauses"](spark, str(tmp_path)).collect()}
    assert got == {("instrument", "i1", "substitute", "5"), ("instrument", "i1", "omit", "6"), ("statute_section_version", "v1", "repeal", "9")}
