import numpy as np
import pytest

from docketry.llm.shapes import label
from docketry.llm.textstats import Profiles, Reader, describe, divergences, fit_profiles, learn_profiles, text_stats

LANGUAGES = {"en": "the of and to in a is was that for on by with at from as it".split(), "ur": "کی کا نے کہ ہے کو میں سے".split()}
WORDS = frozenset(w for ws in LANGUAGES.values() for w in ws)
SUBJECTS = ["appeal", "petition", "tender", "lease", "partition", "rent", "water course", "mutation", "claim", "gift", "award", "plaint"]
NAMES = ["Nasir", "Bushra", "Omar", "Sana", "Rabia", "Tariq", "Habib", "Noor", "Zahid", "Lubna", "Imran", "Farah"]


def prose(i: int, n: int = 4) -> str:
    at = lambda k: SUBJECTS[(i + k) % len(SUBJECTS)]
    return " ".join(f"The {at(3 * k)} was heard by the bench on the {i + k} of June and the order in the {at(k + 5)} from {NAMES[(i + k) % 12]} was set aside, as it is clear that page {i * 7 + k} was read." for k in range(n))


def listing(i: int) -> str:
    mark = ["- ", "o ", "", f"{i}. "][i % 4]
    return "\n".join(f"{mark.replace(str(i), str(k + 1))}{NAMES[(i + k) % 12]} {NAMES[(i * 5 + k * 3 + 1) % 12]} Khan" for k in range(5 + i % 6))


def rows(i: int) -> str:
    cut = ["\t", " | ", ";"][i % 3]
    return "\n".join(cut.join([f"{1000 + i * 13 + k}.{k}5", SUBJECTS[k % 12].title(), f"{10 + k}%", f"{k + 3},{100 + i}"]) for k in range(4 + i % 5))


def junk(i: int) -> str:
    rng = np.random.default_rng(i)
    letters = lambda n, of: "".join(rng.choice(list(of), n))
    return [
        "court " * (20 + i), " ".join(letters(rng.integers(3, 9), "bcdfghjklmnpqrstvwxzaeiou") for _ in range(30)), letters(200, "ABCDEFGHabcdefgh0123456789+/"),
        letters(150, ";:'`~|!_-, "), "".join(c if rng.random() > 0.3 else "�" for c in prose(i, 2)), prose(i, 4 + i % 3) + (" " + prose(i, 2)) * 12,
        "عدالت نے قرار دیا کہ زمین کا انتقال درست ہے".encode().decode("latin1"),
    ][i % 7]


CORPUS = [(prose(i, 1 + i % 7), "prose") for i in range(60)] + [(listing(i), "list") for i in range(40)] + [(rows(i), "table") for i in range(40)] + [(junk(i), "junk") for i in range(56)]
CORPUS += [("عدالت نے قرار دیا کہ زمین کا انتقال درست ہے اور اپیل کو منظور کیا " + str(i), "prose") for i in range(6)]


@pytest.fixture(scope="module")
def fitted():
    reader = Reader(LANGUAGES)
    _, x = reader.read([t for t, _ in CORPUS[::2]])
    return reader, fit_profiles(x, [y for _, y in CORPUS[::2]], reader)


def test_held_out_accuracy(fitted):
    reader, profiles = fitted
    got = describe([t for t, _ in CORPUS[1::2]], reader, profiles)["text_class"]
    assert np.mean([a == b for a, (_, b) in zip(got, CORPUS[1::2])]) >= 0.97


def test_the_divergence_decides(fitted):
    """With the verdicts of the profiles exchanged, the verdicts of all texts follow."""
    reader, profiles = fitted
    other = {"prose": "table", "table": "prose", "list": "junk", "junk": "list"}
    swapped = Profiles(profiles.names, [other[v] for v in profiles.verdicts], profiles.rows, profiles.weight)
    texts = [t for t, _ in CORPUS]
    assert [other[v] for v in describe(texts, reader, profiles)["text_class"]] == list(describe(texts, reader, swapped)["text_class"])


def test_divergence_of_distributions():
    p = np.array([[0.5, 0.5, 0.0], [1.0, 0.0, 0.0]], np.float32)
    got = divergences(p, np.array([[0.5, 0.5, 0.0], [0.0, 0.0, 1.0]], np.float32), np.ones(3, np.float32))
    assert np.allclose(got, [[0, 1], [0.3112781, 1]], atol=1e-5)


def test_repetition_over_any_number_of_sentences(fitted):
    reader, profiles = fitted
    for n in (1, 3, 5, 8):
        assert describe([" ".join([prose(3, n)] * 30)], reader, profiles)["text_class"][0] == "junk", n
        assert label(" ".join([prose(3, n)] * 30), WORDS) == "junk"


def test_counts_and_empty_texts(fitted):
    reader, profiles = fitted
    got = describe(["The order is final.\nAppeal isn't dismissed", None, "", " \n\t"], reader, profiles)
    assert list(got.loc[0, ["n_words", "n_lines", "end_punct_share"]]) == [7, 2, 0.5]
    assert got["common_share"][0] == pytest.approx(2 / 7)
    assert list(got["n_words"][1:]) == [0, 0, 0] and got["text_class"][1:].isna().all()


def test_whole_column_and_plan(spark):
    texts = [t for t, _ in CORPUS] + [None, "", prose(1, 900)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, text_class string")
    profiles = learn_profiles(docs, LANGUAGES)
    found = text_stats(docs, LANGUAGES, profiles, ["list", "table", "junk"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInPandas") == 1 and "ArrowEvalPython" not in plan
    got = dict(found.collect())
    want = {i: y for i, (_, y) in enumerate(CORPUS) if y != "prose"}
    assert sum(got.get(i) == y for i, y in want.items()) >= 0.97 * len(want) and len(got) <= 1.03 * len(want)
    whole = text_stats(docs, LANGUAGES, profiles).orderBy("doc_id").collect()
    assert len(whole) == len(texts) and whole[-1]["text_class"] == "prose" and whole[-3]["text_class"] is None
    none = docs.limit(0)
    assert text_stats(none, LANGUAGES, learn_profiles(none, LANGUAGES)).collect() == []
