import random

import numpy as np

from docketry.llm.names import cell_links, distance, distances, encode, link_variants, radius_links, read_name, variant_pairs


def test_distance_is_a_metric_and_vectorised():
    rng = random.Random(1)
    words = ["", "ab", "ca", "abc", *("".join(rng.choice("abcd") for _ in range(rng.randrange(1, 8))) for _ in range(40))]
    codes, lens = encode(words)
    d = np.stack([distances(w, codes, lens) for w in words])
    assert (d == np.array([[distance(a, b) for b in words] for a in words])).all()
    assert (d == d.T).all() and (np.diag(d) == 0).all()
    assert (d[:, :, None] <= d[:, None, :] + d.T[None, :, :]).all()  # the triangle inequality
    assert distance("ca", "abc") == 2 and distance("arshad", "arhsad") == 1


def test_cell_links_are_all_pairs_at_distance_one():
    rng = random.Random(2)
    words = sorted({"".join(rng.choice("ab ") for _ in range(rng.randrange(1, 7))) for _ in range(120)})
    want = [(a, b) for a in words for b in words if a < b and distance(a, b) == 1]
    assert cell_links(words, [True] * len(words)) == want


def test_partition_loses_no_pair_at_any_level(spark):
    rng = random.Random(3)
    words = sorted({"".join(rng.choice("abcdefg") for _ in range(rng.randrange(8, 14))) for _ in range(200)})
    words = sorted({*words, *(w[:i] + rng.choice("xyz") + w[i + 1 :] for w in words for i in [rng.randrange(1, len(w))])})
    want = [(a, b) for a in words for b in words if a < b and distance(a, b) == 1]
    forms = spark.createDataFrame([("party", w) for w in words] + [("judge", words[0])], "name_kind string, form string")
    for most in (20_000, 60, 2):  # one level, a few, and all of them with cells left for the distributed join
        assert sorted((r["a"], r["b"]) for r in radius_links(forms, frozenset(), most).collect()) == want, most


def test_reading():
    same = [
        ["Justice (R) Bushra Temwopogarin", "BUSHRA TEMWOPOGARIN, J", "Temwopogarin, Bushra", "Hon'ble Justice Bushra Temwopogarin", "Bushra Temwopogarin, C.J.", "Mrs. Bushra  Temwopogarin", "Bushra Temwopogarin s/o Omar Temwopogarin", "Bushra Temwopogarin (deceased) through legal heirs", "Bushra Temwopogarin alias Kaka", "Bushra Temwopogarin and 3 others", "Bushra Temwopogarin, Advocate", "BushraTemwopogarin"],
        ["Northmark Revenue Board", "M/s Northmark Revenue Board", "The Northmark Revenue Bd. and others", "Revenue Board, Northmark", "Northmark Revenue Board (NRB)", "Northmark Revenue Board through its Chairman", "Northmark Revenue Boar."],
        ["The State", "the State.", "THE  STATE", "State", "The State through Advocate-General"],
    ]
    for group in same:
        assert len({read_name(x)["form"] for x in group}) == 1, [read_name(x) for x in group]
    assert len({read_name(g[0])["form"] for g in same}) == 3
    for nobody in (None, "", " ", "-", "N.A.", "Not known", "Before:", "J", "..."):
        assert read_name(nobody) is None
    assert read_name("N.R.B.")["kind"] == "acronym" == read_name("NRB")["kind"]
    assert read_name("E.A. Zirjokebani, JJ")["form"] == "e a zirjokebani"


def linked(spark, names):
    rows = link_variants(spark.createDataFrame([("party", x) for x in names], "name_kind string, name string"))
    return {tuple(r)[1:] for r in variant_pairs(rows).collect()}


def test_linking(spark):
    common = ["Bushra", "Omar", "Tariq", "Zahida", "Khalid"]
    noise = [f"{a} {b} {s}" for a in common for b in common if a != b for s in ("Lorzubanit", "Gemkotarina", "Walsipotor")]
    names = ["Tariq Khalid Shunmebarai", "Shunmebarai Tariq Khalid", "Tariq Khaled Shunmebarai", "Tariq Khalid Shunmebarai", "T.K. Shunmebarai", "Zahida Norpitebani", "Z. Norpitebani", "Zubaida Norpitebani", "Tariq Khalid Shunmebrai",
             "Northmark Revenue Board", "Southmark Revenue Board", "N.R.B.", "SRB", "Southmark Rural Bank", None, "", "N.A."]
    got = linked(spark, names + noise)
    group = sorted({"Tariq Khalid Shunmebarai", "Shunmebarai Tariq Khalid", "Tariq Khaled Shunmebarai", "T.K. Shunmebarai", "Tariq Khalid Shunmebrai"})
    want = {(a, b) for a in group for b in group if a < b} | {("N.R.B.", "Northmark Revenue Board")}
    # two Z. Norpitebani could be meant, and two bodies are called SRB: neither is linked
    assert {p for p in got if not any(n in noise for n in p)} == want
    assert not got - want
    assert linked(spark, []) == set()
