import math

from docketry.llm.scans import CONFUSIONS, Corrector, Language, analyse, channel, count_language, furniture, scan_noise, skeleton, words_of

SENTENCE = "the officer shall report the matter under section twenty of the act and the pre-emptor shall be heard before the order is made by the board"


def corrector(extra=""):
    from collections import Counter

    words = words_of((SENTENCE + " ") * 60 + extra)
    return Corrector(Language(dict(Counter(words)), dict(Counter(zip(words, words[1:]))), len(words)))


def kinds(text, caption=False, extra=""):
    return analyse(text, corrector(extra), caption)


def test_misread_words_come_back():
    got, text = kinds("The off!cer sball rep0rt the rnatter urider scction\ntwenty of the act and the order is made by tbe boarcl.")
    assert got == {"misread"}
    assert text == "The officer shall report the matter under section twenty of the act and the order is made by the board."


def test_cut_words_even_across_a_page():
    got, text = kinds("the officer shall rep-\nort the matter under sect¬\n- 564 -\nTHE BOARD ACT, 1962\nion twenty of the act")
    assert got == {"hyphen", "header", "page_no"}
    assert text == "the officer shall report the matter under section twenty of the act"
    assert kinds("the officer and the pre-\nemptor shall be heard before the order is made")[0] == set()
    assert kinds("see Exh. PW-\n14 of the act and the order of the board")[0] == set()


def test_furniture():
    body = ["the officer shall report the matter under", "section twenty of the act and the order is"]
    for line, want in [("(294)", "page"), ("— 90 —", "page"), ("Page 4 of 9", "page"), ("[12]", "page"), ("440", "page"), ("440  Southmark Weights and Labels Act", "both"), ("     Sec. 20]", "head"),
                       ("[PART I  669", "both"), ("SEED REGISTRATION (CONTROL) ORDER, 2012", "head"), ("Hillmark Shop Hours Act", "head"), ("C.R. No. 166 of 1996", "head"), ("PLD 2010 SC 1573", "head"),
                       ("Hillmark Shop Hours Act,", ""), ("1969.", ""), ("section 48 of the Order", "")]:
        assert furniture([body[0], line, body[1]], False)[1] == want, line
    caption = ["IN THE LAHORE HIGH COURT", "PLD 2010 SC 1573", "C.R. No. 166 of 1996", "ORDER", *body, "C.R. NO. 166 OF 1996", body[1]]
    assert [i for i, m in enumerate(furniture(caption, True)) if m] == [6]
    assert analyse("\n".join([*body, "PLD 2010 SC 1573", "© 2019 Some Reports. All rights reserved."]), corrector(), False)[0] == set()


def test_clean_and_empty_texts():
    for text in ("", None, "  ", SENTENCE, SENTENCE.upper(), "\n\n"):
        assert analyse(text, corrector(), False)[0] == set()


def test_a_common_word_is_no_misreading():
    assert kinds("the officer heard the band before the hand", extra="band hand " * 40)[0] == set()


def test_queries(spark):
    rows = [("statute_section_version", f"s{i}", SENTENCE) for i in range(60)]
    rows += [("statute_section_version", "bad", SENTENCE.replace("shall", "sball", 1)), ("judgment", "cut", "ORDER\n" + SENTENCE.replace("heard", "hea-\nrd")), ("judgment", "null", None), ("judgment", "long", (SENTENCE + "\n") * 3000)]
    df = spark.createDataFrame(rows, "source_table string, record_id string, text string")
    language = count_language(df)
    assert language.words["officer"] == 60 + 1 + 1 + 3000 and language.pairs[("the", "officer")] == 3062
    got = sorted(map(tuple, scan_noise(df, language, ["judgment"]).collect()))
    assert got == [("judgment", "cut", "hyphen"), ("statute_section_version", "bad", "misread")]
    fixed = {r["record_id"]: r["repaired_text"] for r in scan_noise(df, language, ["judgment"], repaired=True).collect()}
    assert fixed["bad"] == SENTENCE and fixed["cut"] == "ORDER\n" + SENTENCE
    none = df.limit(0)
    assert scan_noise(none, count_language(none), []).count() == 0


def test_a_word_counts_however_large_the_corpus_is(spark):
    rows = [("judgment", f"j{i}", "the kembazodani paid the fee") for i in range(5)] + [("judgment", "bad", "the kem8azodani paid the fee"), ("judgment", "cut", "the kem8azo-\ndani paid the fee")]
    few = spark.createDataFrame(rows, "source_table string, record_id string, text string")
    filler = spark.range(1000, numPartitions=4).selectExpr("repeat('the ', 12000) AS text")
    language = count_language(few.select("text").unionByName(filler))
    assert language.words["kembazodani"] == 5 and language.words["the"] > 12_000_000
    got = {(r["record_id"], r["repaired_text"]) for r in scan_noise(few, language, ["judgment"], repaired=True).collect()}
    assert got == {("bad", "the kembazodani paid the fee"), ("cut", "the kembazodani paid the fee")}


def test_channel_is_the_likeliest_way_and_unbounded():
    cost = {(w, r): math.log(p) for w, r, p in CONFUSIONS}
    assert channel("order", "order") == 0.0 and channel("order", "ordor") is None
    assert math.isclose(channel("modern", "rnodcrn"), cost["m", "rn"] + cost["e", "c"])
    word, read = "seenlessness", "5cc" + "ri" + "lc55" + "ri" + "c55"  # nine confusions, and every one of many candidates is kept
    assert math.isclose(channel(word, read), 5 * cost["s", "5"] + 4 * cost["e", "c"] + 2 * cost["n", "ri"])
    assert skeleton(word) == skeleton(read)
    for w, r, _ in CONFUSIONS:
        assert skeleton(f"x{w}x") == skeleton(f"x{r}x"), (w, r)
