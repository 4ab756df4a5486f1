import numpy as np
from pyspark.sql import functions as F

from docketry.llm import blocks, residue
from docketry.llm.pages import page_leaves, text_leaves
from docketry.llm.seeds import MAIN, RESIDUE, SITE, label_lines, label_page, label_record
from docketry.llm.web import fit_models, labelled_pieces, main_text, residue_records, site_pieces

COMMON = frozenset("the of and to in a was that by is for be it this on with".split())
PROSE = "The appeal was heard by the bench and the order of the court was set aside in the end."


def page(i, body=None):
    body = body or f"<p>{PROSE} Case number {i} was read.</p><p>It is clear that the record of the case was read in full on day {i}.</p>"
    return f"<html><head><title>t</title></head><body><nav><a href='/1'>Home</a><a href='/2'>Search</a></nav><main><h1>Ali Baig v. Omar Khan {i}</h1>{body}</main><footer><span>© 2019 Some Law Reports. All rights reserved.</span></footer></body></html>"


def text(i, body=None):
    return "\n".join(["Some Law Reports", "Home", "Search", "", "Lahore High Court", f"Ali Baig v. Omar Khan {i}", f"W.P. No. {i} of 1990", "JUDGMENT", body or PROSE, "Appeal dismissed.", "© 2019 Some Law Reports. All rights reserved."])


def test_page_leaves_are_runs_between_tags():
    html = "x<html><title>no</title><body>a<b>b &amp; c</b> \n <p>d<br>e<!-- f -->g</p><script>if (a<b) {}</script><noscript>turn <b>on</b></noscript><style>p{}</style>&nbsp;<i>h</i></p></div>z"
    leaves, hidden = page_leaves(html)
    assert [x for x, _, _ in leaves] == ["x", "a", "b & c", "d", "e", "g", "h", "z"]
    assert hidden == "turn on"
    assert leaves[2][1] == ("html", "body", "b")
    assert page_leaves(None) == ([], "") and page_leaves("") == ([], "") and page_leaves("<p") == ([("<p", (), ())], "")
    assert text_leaves("a\n\n b  c \n") == [(1, "a"), (3, "b c")] and text_leaves(None) == []


def test_network_gradient_matches_differences():
    rng = np.random.default_rng(1)
    x, mask = rng.standard_normal((4, 2, blocks.DIM)).astype(np.float32), np.ones((4, 2, 1), np.float32)
    mask[3, 1] = 0
    model = blocks.BlockModel.new(2)
    weight = rng.standard_normal((4, 2, blocks.HIDDEN)).astype(np.float32)
    for k, back in ((0, False), (1, True)):
        wx, wh, b = model.wx[k].astype(np.float64), model.wh[k].astype(np.float64), model.b[k].astype(np.float64)
        loss = lambda x_, wx=wx, wh=wh, b=b, back=back: float((blocks._run(x_, mask, wx, wh, b, back, False)[0] * weight).sum())
        _, trace = blocks._run(x, mask, wx, wh, b, back, True)
        dx, _, _, _ = blocks._unroll(weight, x, mask, wx, wh, trace, back)
        for at in ((0, 0, 3), (2, 1, 5), (3, 0, 1), (3, 1, 1)):
            hi, lo = x.astype(np.float64), x.astype(np.float64)
            hi[at] += 1e-2
            lo[at] -= 1e-2
            assert abs((loss(hi) - loss(lo)) / 2e-2 - dx[at]) < 2e-2


def test_seed_labels():
    lines = [x for _, x in text_leaves(text(3))]
    assert label_lines(lines, COMMON) == [SITE] * 3 + [MAIN] * 6 + [SITE]
    leaves = page_leaves(page(3))[0]
    assert label_page(leaves, COMMON) == [SITE, SITE, MAIN, MAIN, MAIN, SITE]
    assert label_record(["Home", "{{judge}} versus {{court}}", "Before: {{judge}}"], [SITE, MAIN, MAIN], COMMON) == [SITE, RESIDUE, RESIDUE]
    assert label_record([PROSE, "Access denied was the answer."], [MAIN, MAIN], COMMON) is None


def test_web_queries(spark):
    bad = ["IN THE {{court}} {{judge}} versus {{state}}", "Page not found. Check the address and try again.", "Lorem ipsum placeholder text, replace with content.", "Please turn on JavaScript to read this page."]
    pages = [(f"p{i}", page(i)) for i in range(160)] + [(f"bp{i}", page(i, f"<p>{bad[i % 4]}</p>").replace(f"Ali Baig v. Omar Khan {i}", "Some Law Reports")) for i in range(40)]
    pages += [("null", None), ("empty", ""), ("blank", "<html><body> </body></html>"), ("shell", "<html><body><div></div><noscript>Please turn on JavaScript to read this page.</noscript></body></html>")]
    texts = [(f"t{i}", text(i)) for i in range(160)] + [(f"bt{i}", bad[i % 4]) for i in range(40)]
    texts += [("trap", text(7, PROSE + " Page not found was the answer that the system gave.")), ("long", text(9, "\n".join([PROSE] * 2000)))]
    as_df = lambda rows, name, kind: spark.createDataFrame(rows, "record_id string, body string").select(F.lit(name).alias("source_table"), "record_id", F.lit(kind).alias("kind"), "body")
    p, t = as_df(pages, "page_result", "page"), as_df(texts, "judgment", "text")
    models = fit_models(p, t, sorted(COMMON), with_blocks=True)
    found = {r["record_id"] for r in residue_records(p.unionByName(t), models).collect()}
    assert found == {f"bp{i}" for i in range(40)} | {f"bt{i}" for i in range(40)} | {"shell"}
    pieces = labelled_pieces(p.unionByName(t), models)
    rows = pieces.collect()
    assert not found & {r["record_id"] for r in rows}
    site = {(r["record_id"], r["piece_no"]) for r in rows if r["site"]}
    assert site == {(r["record_id"], r["piece_no"]) for r in site_pieces(p.unionByName(t), models).collect()}
    want = {(f"p{i}", k) for i in range(160) for k in (1, 2, 6)} | {(i, k) for i in [f"t{k}" for k in range(160)] + ["trap"] for k in (1, 2, 3, 11)} | {("long", k) for k in (1, 2, 3, 2010)}
    assert len(site ^ want) <= 0.01 * len(want)
    assert "Home" not in {r["record_id"]: r["main_text"] for r in main_text(pieces).collect()}["p5"]
    none = fit_models(p.limit(0), t.limit(0), sorted(COMMON), with_blocks=True)
    assert residue_records(p.limit(0), none).count() == 0 and labelled_pieces(p.limit(0), none).count() == 0


def _texts(spark, rows):
    return spark.createDataFrame(rows, "record_id string, body string").select(F.lit("judgment").alias("source_table"), "record_id", F.lit("text").alias("kind"), "body")


def test_residue_is_learnt_from_every_record(spark):
    ids = [r["id"] for r in spark.range(1640).select(F.concat(F.lit("r"), "id").alias("id")).orderBy(F.xxhash64("id")).collect()]
    rows = [(i, f"Lahore High Court\n{PROSE}\nNumber {k} of the list.") for k, i in enumerate(ids[:1600])]
    rows += [(i, f"{{{{caption}}}} zwuk mopelt drasti fengol {{{{n{k}}}}}") for k, i in enumerate(ids[1600:])]
    texts = _texts(spark, rows)
    models = fit_models(texts.limit(0), texts, sorted(COMMON), with_blocks=False)
    new = _texts(spark, [("alike", "zwuk mopelt drasti fengol"), ("case", PROSE)])
    assert {r["record_id"] for r in residue_records(texts.unionByName(new), models).collect()} == {*ids[1600:], "alike"}


def test_residue_models_equal_the_counts_of_all_records(spark):
    notice = "Readers may write to the keeper of these pages at any time."
    order = "It was said in the order of the court below."
    bodies = [text(k, f"{PROSE} Item {k}.") + (f"\n{notice}" if k % 3 else "") for k in range(900)] + [f"{PROSE} Item {k}.\n{order}" for k in range(700)]
    bodies += ["IN THE {{court}} {{judge}} versus {{state}}"] * 30 + [f"{PROSE}\nAccess denied was the answer.", "IN THE {{court}} {{judge}} versus {{state}}\nLahore High Court", None, "", " \n "]
    texts = _texts(spark, [(f"t{k}", x) for k, x in enumerate(bodies)])
    got = fit_models(texts.limit(0), texts, sorted(COMMON), with_blocks=False).residue
    records = [leaves for x in bodies if (leaves := [x for _, x in text_leaves(x)])]
    labels = [label_record(x, label_lines(x, COMMON), COMMON) for x in records]
    labels = [y and [SITE if leaf == notice else z for leaf, z in zip(x, y)] for x, y in zip(records, labels)]

    def counts(labels):
        grams = residue.GramCounts()
        for x, y in zip(records, labels):
            if y is not None:
                grams.add(x, y)
        return grams.total()

    again = residue.second_labels(residue.fit(counts(labels)), records, labels)
    assert None in labels and again != labels
    assert np.array_equal(got.tables, residue.fit(counts(again)).tables)
