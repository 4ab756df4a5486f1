"""Variant spellings of names typed by people: one entity under many spellings.

Names are read into forms: titles, offices and the like are taken off, abbreviations written out, parts put in
order. Forms within a radius of a true edit metric (Damerau-Levenshtein with unrestricted transpositions) are found
by metric-space partitioning: each form goes to the cell of its nearest pivot and, where the triangle inequality
allows a partner in another cell, to that cell as well; inside a cell the radius join is exact. Initials, bare
surnames and acronyms are tied to the one entity that they can mean. Links become groups by connected components.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.llm.components import connected_components
from docketry.operators.skew import skew_join
from docketry.session import checkpointed, shuffle_width

#: Radius of the join; pivots at a time, a bounded sample, the forms with the smallest hashes; levels of pivots, each with rings
#: between, through which a cell is parted until it has at most CELL forms; width of a ring.
RADIUS, PIVOTS, LEVELS, CELL, RING = 1, 16, 4, 20_000, 4
#: How often a level may repeat a form on average and still be worth it.
MOST_COPIES = 4
#: A given name is common from this share of the forms and this count on: at most 3 / share can be, as forms have few parts.
COMMON_SHARE, COMMON_LEAST = 0.005, 8

# Words that are no part of a name.
NOBODY = frozenset(("", "-", "--", "n.a.", "na", "n/a", "nil", "none", "null", "not known", "unknown", "not available", "before", "present", "coram", "j", "jj", "cj", "c.j", "?", "x", "xx", "xxx", "anonymous", "not applicable", "not stated"))
TITLES = frozenset(
    "justice mr mrs ms miss mst dr prof ch haji hafiz syed sayed sardar malik rana mian sheikh shaikh maulana hon honble hon'ble honourable the their lordships lordship lady acting chief judge j jj cj acj r retd retired member chairman president advocate adv barrister smt sh shri sri messrs m/s".split()
)
_TAILS = re.compile(
    r"(?:,|\s)\s*(?:\(?(?:since )?deceased\)?.*|through\b.*|thr\b\.?.*|alias\b.*|a\.?k\.?a\b\.?.*|@.*|[swd]\s?/\s?o\b.*|(?:son|wife|daughter|widow) of\b.*|(?:and|&)\s+(?:\d+\s+|an)?others?\b.*|etc\.?.*|advocate\b.*|represented by\b.*|by (?:his|her|its)\b.*)$",
    re.I,
)
_PAREN = re.compile(r"\(([^)]*)\)")

# Words of bodies and how they are cut short.
BODY_WORDS = ["authority", "board", "corporation", "department", "society", "company", "limited", "private", "commission", "committee", "council", "bank", "university", "ministry", "government", "federation", "development", "cooperative", "mills", "municipal", "district", "institute", "association", "trust", "foundation", "industries", "insurance", "directorate"]
BODY_SHORT = {
    "auth": "authority", "bd": "board", "brd": "board", "corp": "corporation", "corpn": "corporation", "deptt": "department", "dept": "department", "soc": "society", "socy": "society", "co": "company", "ltd": "limited", "pvt": "private",
    "comm": "commission", "cttee": "committee", "dev": "development", "devt": "development", "coop": "cooperative", "co-op": "cooperative", "ml": "mills", "mls": "mills", "assn": "association", "govt": "government", "inst": "institute", "univ": "university",
}

# Given names that are short for, or another spelling of, the same name beyond what the metric reaches.
SAME_NAME = {
    "jimmy": "jamshed", "zulfi": "zulfiqar", "jamshaid": "jamshed", "jamsheed": "jamshed", "jamshid": "jamshed", "md": "muhammad", "mohd": "muhammad", "m'd": "muhammad", "mohammad": "muhammad", "mohammed": "muhammad", "muhammed": "muhammad", "gh": "ghulam", "abd-ul": "abdul", "abd": "abdul", "abdool": "abdul", "yusuf": "yousaf", "yousuf": "yousaf", "yusaf": "yousaf", "umer": "omar", "umar": "omar", "obaid": "ubaid",
    "waseem": "vaseem", "wasim": "vaseem", "vasim": "vaseem", "hussain": "husain", "hussein": "husain", "tahira": "tahera", "zaheda": "zahida", "parvez": "pervaiz", "pervez": "pervaiz", "perwaiz": "pervaiz", "kalsum": "kulsoom", "kulsum": "kulsoom", "fozia": "fauzia", "fouzia": "fauzia",
    "jawed": "javed", "javaid": "javed", "jawaid": "javed", "dilaver": "dilawar", "sikander": "sikandar", "iskandar": "sikandar", "zubeda": "zubaida", "zubeida": "zubaida", "bisharat": "basharat", "ihsan": "ehsan", "ijaz": "ejaz", "aijaz": "ejaz", "eijaz": "ejaz", "kaiser": "qaiser", "qaisar": "qaiser", "rukhsanah": "rukhsana",
    "shahina": "shaheena", "mahnaz": "mehnaz", "nahid": "naheed", "nasrin": "nasreen", "yasmin": "yasmeen", "perveen": "parveen", "parvin": "parveen", "salim": "saleem", "nadim": "nadeem", "navid": "naveed", "rashid": "rasheed", "farid": "fareed", "latif": "lateef", "habib": "habeeb", "khaled": "khalid", "harun": "haroon", "tarik": "tariq", "tareeq": "tariq", "tanvir": "tanveer", "vaqas": "waqas", "vaqar": "waqar",
}

_VERBATIM = re.compile(r"[^a-z0-9'&/.\- ]+")


def _squeeze(w: str) -> str:
    """A given name with its vowel length, double letters and like-sounding letters levelled."""
    w = SAME_NAME.get(w, w)
    w = w.replace("ee", "i").replace("oo", "u").replace("ou", "u").replace("q", "k").replace("kh", "k") if len(w) > 3 else w
    w = re.sub(r"(.)\1", r"\1", w)
    w = re.sub(r"ai(?=[^aeiouy])", "e", w) if len(w) > 4 else w
    w = re.sub(r"iya", "ia", w)
    return re.sub(r"(?<=[^aeiou])h$|(?<=a)h$", "", w) if len(w) > 4 else w


def _body_word(w: str) -> str:
    """A word of a body's name written out; cut short by a point, cut off anywhere, or with one slip."""
    bare = w.strip(".")
    if bare in BODY_WORDS:
        return bare
    if bare in BODY_SHORT:
        return BODY_SHORT[bare]
    if w.endswith(".") and len(bare) >= 2:
        hit = [x for x in BODY_WORDS if x.startswith(bare)]
        if len(hit) == 1 or hit and len(bare) >= 3:
            return hit[0]
    if len(bare) >= 3:
        near = [x for x in [*BODY_SHORT, *BODY_WORDS] if abs(len(x) - len(bare)) <= 1 and (len(bare) >= 5 or w.endswith(".")) and len(x) >= 3 and distance(bare, x) <= 1]
        if near:
            best = min(near, key=lambda x: (-len(x), x))
            return BODY_SHORT.get(best, best)
    return bare


def _is_title(t: str, part: list[str], place: int) -> bool:
    """A title or office; single letters are initials, but for J and, after a comma, R."""
    bare = t.strip(".'")
    if len(bare) == 1:
        return bare == "j" and (len(part) == 1 or t is part[-1]) or bare == "r" and place > 0
    if re.fullmatch(r"(?:[a-z]\.)+[a-z]?", bare + "."):
        return bare.replace(".", "") in ("cj", "jj", "acj")
    return bare in TITLES


def read_name(raw: str | None) -> dict | None:
    """A name as typed, read into a form; None where it names nobody.

    ``kind`` is person, body or acronym; ``form`` the parts in order, the surname of a person last; ``full`` tells
    whether every part is written out; ``acronym`` an acronym that the string itself gives for its body.
    """
    if raw is None:
        return None
    s = " ".join(re.sub(r"(?<=[a-z]{2})(?=[A-Z][a-z])", " ", raw.replace("’", "'").replace("`", "'")).split())
    low = s.lower().strip(" .,:;-")
    if low in NOBODY or low.replace(".", "") in NOBODY or not any(c.isalpha() for c in low):
        return None
    given = ""
    for inside in _PAREN.findall(s):
        if re.fullmatch(r"[A-Z][A-Z.]{1,9}", inside.strip()) and len(inside.replace(".", "")) >= 2:
            given = inside.replace(".", "").strip().lower()
    s = _TAILS.sub("", f"{s} ").strip()
    s = _TAILS.sub("", f"{s} ").strip()
    s = _PAREN.sub(" ", s).strip(" ,;:-")
    letters = re.sub(r"[^A-Za-z]", "", s)
    if re.fullmatch(r"(?:[A-Z]\.?\s?){2,9}", s) and letters.isupper() and not re.search(r"\s[A-Z]{3,}", s) and len(letters) <= 6:
        return {"kind": "acronym", "form": letters.lower(), "full": False, "acronym": "", "surname": "", "initials": ""}
    comma = [p.strip() for p in s.split(",") if p.strip()]
    parts = [[t for t in re.split(r"[\s]+", p.lower()) if t.strip(".-&'")] for p in comma]
    parts = [[t for t in p if not _is_title(t, p, k)] for k, p in enumerate(parts)]
    parts = [p for p in parts if p]
    if not parts:
        return None
    flat = [t for p in parts for t in p]
    if len(flat) > 1 and flat[-1].strip(".") == "j":
        parts[-1] = parts[-1][:-1]
        parts = [p for p in parts if p]
        flat = [t for p in parts for t in p]
    words = [_VERBATIM.sub("", t) for t in flat]
    bodies = [_body_word(t) for t in words]
    if sum(b in BODY_WORDS for b in bodies) >= 1 and len(words) >= 2 and (bodies[-1] in BODY_WORDS or len(parts) == 2 and any(_body_word(t) in BODY_WORDS for t in parts[0])):
        if len(parts) == 2 and any(_body_word(t) in BODY_WORDS for t in parts[0]):
            words = [_VERBATIM.sub("", t) for t in parts[1] + parts[0]]
        form = [b for b in (_body_word(t) for t in words) if b not in ("the", "of", "and")]
        return {"kind": "body", "form": " ".join(form), "full": True, "acronym": given, "surname": form[0], "initials": "".join(b[0] for b in form)}
    if len(words) == 1 and len(words[0]) <= 6 or words[-1:] in (["state"], ["crown"], ["federation"]) and len(words) == 1:
        w = words[0].strip(".")
        return {"kind": "body", "form": w, "full": True, "acronym": "", "surname": w, "initials": w[:1]} if len(w) >= 3 else None
    if len(parts) == 2 and len(parts[0]) == 1:
        parts = [parts[1] + parts[0]]
    tokens: list[str] = []
    for t in (t for p in parts for t in p):
        if re.fullmatch(r"(?:[a-z]\.)+[a-z]?\.?", t):
            tokens += [x for x in t.split(".") if x]
        else:
            tokens.append(t.strip(".'-"))
    tokens = [_VERBATIM.sub("", t) for t in tokens if t]
    if not tokens or len(tokens[-1]) < 2 and len(tokens) < 2:
        return None
    return {"kind": "person", "form": " ".join(tokens), "full": len(tokens) > 1 and all(len(t) > 1 for t in tokens), "acronym": "", "surname": tokens[-1], "initials": "".join(t[0] for t in tokens[:-1])}


def distance(a: str, b: str) -> int:
    """Damerau-Levenshtein distance with unrestricted transpositions, which is a metric."""
    if a == b:
        return 0
    last: dict[str, int] = {}
    n, m = len(a), len(b)
    big = n + m
    d = [[big] * (m + 2) for _ in range(n + 2)]
    for i in range(n + 1):
        d[i + 1][1] = i
    for j in range(m + 1):
        d[1][j + 1] = j
    for i in range(1, n + 1):
        at = 0
        for j in range(1, m + 1):
            k, q = last.get(b[j - 1], 0), at
            cost = 1
            if a[i - 1] == b[j - 1]:
                cost, at = 0, j
            d[i + 1][j + 1] = min(d[i][j] + cost, d[i + 1][j] + 1, d[i][j + 1] + 1, d[k][q] + (i - k - 1) + 1 + (j - q - 1))
        last[a[i - 1]] = i
    return d[n + 1][m + 1]


def distances(one: str, many: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """``distance`` of one string to many at once; ``many`` has their codes, padded with 0, one string a row."""
    n, (count, width) = len(one), many.shape
    letters, seen = np.unique(many, return_inverse=True)
    seen = seen.reshape(many.shape)
    number = {int(c): i for i, c in enumerate(letters)}
    codes = np.frombuffer(one.encode("utf-32-le"), np.uint32)
    big = n + width
    d = np.full((n + 2, width + 2, count), big, np.int16)
    d[1:, 1, :] = np.arange(n + 1)[:, None]
    d[1, 1:, :] = np.arange(width + 1)[:, None]
    cols = np.arange(count)
    last = np.zeros(len(letters), np.int64)  # the row of the last equal letter of ``one``, by letter
    for i in range(1, n + 1):
        at = np.zeros(count, np.int64)
        for j in range(1, width + 1):
            same = many[:, j - 1] == codes[i - 1]
            k = last[seen[:, j - 1]]
            value = np.minimum(np.minimum(d[i, j] + (~same), d[i + 1, j] + 1), d[i, j + 1] + 1)
            if k.any():
                value = np.minimum(value, d[k, at, cols] + (i - k - 1) + 1 + (j - at - 1))
            d[i + 1, j + 1] = value
            at = np.where(same, j, at)
        if int(codes[i - 1]) in number:
            last[number[int(codes[i - 1])]] = i
    return d[n + 1, lens + 1, cols].astype(np.int32)


def encode(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(codes padded with 0, lengths) of strings."""
    lens = np.array([len(t) for t in texts], np.int64)
    out = np.zeros((len(texts), int(lens.max(initial=1))), np.uint32)
    for i, t in enumerate(texts):
        out[i, : len(t)] = np.frombuffer(t.encode("utf-32-le"), np.uint32)
    return out, lens


FORM_SCHEMA = "kind string, form string, full boolean, acronym string, surname string, initials string"


def read_names(names: DataFrame) -> DataFrame:
    """(name_kind, name, kind, form, full, acronym, surname, initials) of the names that name somebody; see ``read_name``."""

    def read(batches):
        columns = [c.split()[0] for c in FORM_SCHEMA.split(", ")]
        for batch in batches:
            rows = [(k, x, r) for k, x in zip(batch["name_kind"], batch["name"]) if (r := read_name(x))]
            yield pd.DataFrame([(k, x, *(r[c] for c in columns)) for k, x, r in rows], columns=["name_kind", "name", *columns], dtype=object)

    return names.select("name_kind", "name").mapInPandas(read, "name_kind string, name string, " + FORM_SCHEMA)


def level(form: str, common: dict[str, str], slips: dict[str, str]) -> str:
    """A person's form with the surname last, also where it was typed first, and the given names levelled.

    ``common`` has the given names that are common and their levels. A given name that is not common but one slip away
    from common ones of one level, or from a known other spelling, is taken for that one. ``slips`` remembers what was found.
    """
    levels = set(common.values())
    t = form.split()
    lev = [_squeeze(x) for x in t]
    for i, x in enumerate(t):
        if len(x) > 3 and lev[i] not in levels and (i < len(t) - 1):
            if x not in slips:
                if len(slips) > 200_000:
                    slips.clear()
                near = {common[c] for c in common if abs(len(c) - len(x)) <= 1 and distance(c, x) <= 1}
                near = near or {_squeeze(y) for y in SAME_NAME if abs(len(y) - len(x)) <= 1 and len(y) > 3 and distance(x, y) <= 1}
                slips[x] = near.pop() if len(near) == 1 else lev[i]
            lev[i] = slips[x]
    if len(t) > 1 and len(t[0]) > 1 and lev[-1] in levels and lev[0] not in levels:
        t, lev = t[1:] + t[:1], lev[1:] + lev[:1]
    return " ".join([*lev[:-1], t[-1]])


def _deletions(s: str) -> set[str]:
    return {s, *(s[:i] + s[i + 1 :] for i in range(len(s)))}


def cell_links(forms: list[str], home: list[bool]) -> list[tuple[str, str]]:
    """All pairs at distance 1 of a cell that have a home member, smaller form first.

    Two strings one edit apart share a string that lacks at most one character of each, so the pairs come from
    equal deletions and are then measured; nothing else is compared.
    """
    at: dict[str, list[int]] = {}
    for i, f in enumerate(forms):
        for d in _deletions(f):
            at.setdefault(d, []).append(i)
    found = set()
    for i, f in enumerate(forms):
        if not home[i]:
            continue
        for d in _deletions(f):
            for j in at[d]:
                if j != i and forms[j] != f:
                    pair = (f, forms[j]) if f < forms[j] else (forms[j], f)
                    if pair not in found and distance(*pair) <= RADIUS:
                        found.add(pair)
    return sorted(found)


def plausible(a: str, b: str, common: frozenset[str]) -> bool:
    """Whether two forms one edit apart can be one name: as many parts, no other initial, no two different common names, no short word changed."""
    x, y = a.split(), b.split()
    if len(x) != len(y):
        return False
    for p, q in zip(x, y):
        if p != q:
            if min(len(p), len(q)) < 3 or (p in common and q in common):
                return False
    return True


def _near_pivots(pivots: list[str], forms: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, pivot, home) of the cells of forms: home with the nearest pivot, repeated at every pivot that is not farther than
    the nearest by more than twice the radius, for only there can a partner be at home."""
    codes, lens = encode(forms)
    far = np.stack([distances(p, codes, lens) for p in pivots])
    cell, row = np.nonzero(far <= far.min(axis=0) + 2 * RADIUS)
    return row, cell, far.argmin(axis=0)[row] == cell


def _rings(far: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, ring, home) of forms at distances ``far`` from one pivot: home in the ring of their distance, repeated in the next one within the radius."""
    rings = np.stack([(far + s) // width for s in (-RADIUS, 0, RADIUS)])
    row = np.concatenate([np.arange(len(far))] * 3)
    cell = rings.ravel()
    pairs = np.unique(np.stack([row, cell]), axis=1)
    return pairs[0], pairs[1], far[pairs[0]] // width == pairs[1]


def radius_links(forms: DataFrame, common: frozenset[str], most: int = CELL) -> DataFrame:
    """(kind, a, b) of the forms (name_kind, form) within RADIUS of each other, by metric-space partitioning.

    Forms are parted by their nearest pivot. A cell of more than ``most`` forms is parted again: into rings around the empty
    string (the distance from which is the length), then by the nearest of other pivots, into rings around another one, and so
    on through the LEVELS. The triangle inequality tells at each level where a form must be repeated, so that no pair is lost
    at any. The join of a cell is exact. Cells that no level makes small, or that one could part only by repeating forms more
    than MOST_COPIES times, are joined by their deletions over all executors.
    """
    spark = forms.sparkSession
    empty = "name_kind string, a string, b string"
    picked = [r["form"] for r in forms.select("form").distinct().orderBy(F.xxhash64("form"), "form").limit(PIVOTS * LEVELS).collect()]
    if not picked:
        return spark.createDataFrame([], empty)
    sets = [picked[k * PIVOTS : (k + 1) * PIVOTS] or picked[:PIVOTS] for k in range(LEVELS)]
    schema = "name_kind string, cell string, home boolean, form string"

    def parted(level: int):
        def part(batches):
            for batch in batches:
                if not len(batch):
                    continue
                names = list(batch["form"])
                if level % 2 == 0:
                    row, cell, home = _near_pivots(sets[level // 2], names)
                else:
                    lens = np.array(list(map(len, names)))
                    row, cell, home = _rings(lens if level == 1 else distances(sets[level // 2][0], *encode(names)), RING)
                whole = batch.iloc[row]
                yield pd.DataFrame({"name_kind": whole["name_kind"].to_numpy(), "cell": [f"{c}/{k}" for c, k in zip(whole["cell"], cell)], "home": whole["home"].to_numpy() & home, "form": whole["form"].to_numpy()})

        return part

    def join(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("home", ascending=False).drop_duplicates("form")
        links = [p for p in cell_links(list(rows["form"]), list(rows["home"])) if plausible(*p, common)]
        return pd.DataFrame({"name_kind": [rows["name_kind"].iloc[0]] * len(links), "a": [a for a, _ in links], "b": [b for _, b in links]}, dtype=object)

    width = shuffle_width(spark)
    todo = forms.select("name_kind", F.lit("").alias("cell"), F.lit(True).alias("home"), "form").distinct().repartition(width)
    found = []
    before = 0
    for level in range(2 * LEVELS):
        placed = checkpointed(todo.mapInPandas(parted(level), schema))
        after = placed.count()
        if level and after > MOST_COPIES * before:
            found.append(_joined_by_deletions(todo, common))
            break
        sizes = placed.groupBy("name_kind", "cell").agg(F.count(F.lit(1)).alias("n"))
        small = placed.join(sizes.where(F.col("n") <= most), ["name_kind", "cell"], "left_semi")
        found.append(small.repartition(width, "name_kind", "cell").groupBy("name_kind", "cell").applyInPandas(join, empty))
        large = sizes.where(F.col("n") > most)
        if large.isEmpty():
            break
        todo = checkpointed(placed.join(large, ["name_kind", "cell"], "left_semi").select("name_kind", "cell", "home", "form").repartition(width))
        before = todo.count()
    else:
        found.append(_joined_by_deletions(todo, common))
    out = found[0]
    for other in found[1:]:
        out = out.unionByName(other)
    return out.distinct()


def _joined_by_deletions(rows: DataFrame, common: frozenset[str]) -> DataFrame:
    """The pairs of cells that are too large for one task: two forms one edit apart share a string that lacks at most one character of each."""

    def spell(batches):
        for batch in batches:
            keys = [sorted(_deletions(f)) for f in batch["form"]]
            n = list(map(len, keys))
            yield pd.DataFrame({"name_kind": np.repeat(batch["name_kind"].to_numpy(), n), "cell": np.repeat(batch["cell"].to_numpy(), n), "home": np.repeat(batch["home"].to_numpy(), n), "form": np.repeat(batch["form"].to_numpy(), n), "key": [k for ks in keys for k in ks]})

    def measure(batches):
        for batch in batches:
            keep = [distance(a, b) <= RADIUS and plausible(a, b, common) for a, b in zip(batch["a"], batch["b"])]
            yield batch.loc[keep, ["name_kind", "a", "b"]]

    spelled = rows.mapInPandas(spell, "name_kind string, cell string, home boolean, form string, key string")
    one, two = spelled.where("home").withColumnRenamed("form", "a").drop("home"), spelled.withColumnRenamed("form", "b").drop("home")
    pairs = one.join(two, ["name_kind", "cell", "key"]).where("a <> b").select("name_kind", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return pairs.mapInPandas(measure, "name_kind string, a string, b string")


def _short_keys(form: str, full: bool) -> list[str]:
    """The shortened forms that a full name may appear under: surname alone, and with initials."""
    t = form.split()
    if not full or len(t) < 2:
        return []
    g, s = t[:-1], t[-1]
    i = [x[0] for x in g]
    keys = {s, f"{i[0]} {s}", " ".join([*i, s])}
    if len(g) > 1:
        keys |= {" ".join([i[0], *g[1:], s]), " ".join([*g[:-1], i[-1], s])}
    return sorted(keys - {form})


def link_variants(names: DataFrame) -> DataFrame:
    """(name_kind, name, entity) for every distinct string of (name_kind, name) that names somebody.

    Repeated strings are reduced before anything else. Nulls, blanks and marks for unknown are left out. Initials,
    bare surnames and acronyms join an entity only if there is exactly one that they fit; otherwise they stay by
    themselves. An empty table gives no rows.
    """
    raw = names.where(F.col("name").isNotNull()).groupBy("name_kind", "name").agg(F.lit(1).alias("_one")).drop("_one")
    # reading and placing are heavy for the bytes they take, so their parts are stated and not left to be merged by size
    width = shuffle_width(names.sparkSession)
    read = checkpointed(read_names(raw.repartition(width)))
    parts = read.where("kind = 'person'").select("name_kind", "form").distinct().select(F.explode(F.split("form", " ")).alias("t"), (F.size(F.split("form", " "))).alias("n"))
    total = max(1, read.count())
    tokens = parts.where("length(t) > 2 and n > 1").groupBy("t").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= max(COMMON_LEAST, COMMON_SHARE * total))
    given = {r["t"]: _squeeze(r["t"]) for r in tokens.collect()}
    common = frozenset(given.values())

    @F.pandas_udf("string")
    def levelled(form: pd.Series, kind: pd.Series) -> pd.Series:
        slips: dict[str, str] = {}
        return pd.Series([level(f, given, slips) if k == "person" else f for f, k in zip(form, kind)], dtype=object)

    @F.pandas_udf("array<string>")
    def short_keys(form: pd.Series, full: pd.Series) -> pd.Series:
        return pd.Series([_short_keys(f, bool(k)) for f, k in zip(form, full)], dtype=object)

    node = F.xxhash64("name_kind", F.when(F.col("kind") == "acronym", F.concat(F.lit("\x01"), "form")).otherwise(F.col("form")))
    nodes = checkpointed(read.withColumn("form", levelled("form", "kind")).withColumn("node", node))
    forms = nodes.groupBy("name_kind", "kind", "form", "node").agg(F.max("full").alias("full"), F.max("initials").alias("initials"))
    spelled = forms.where("kind <> 'acronym'")
    links = radius_links(spelled, common).select(F.xxhash64("name_kind", "a").alias("src"), F.xxhash64("name_kind", "b").alias("dst"))
    links = checkpointed(links)
    first = connected_components(links).withColumnRenamed("id", "node")
    entity = forms.join(first, "node", "left").withColumn("entity", F.coalesce("group_id", "node")).drop("group_id")

    keys = entity.where("kind = 'person' and full").select("name_kind", F.explode(short_keys("form", "full")).alias("key"), "entity")
    one = keys.groupBy("name_kind", "key").agg(F.min("entity").alias("low"), F.max("entity").alias("high")).where("low = high")
    shorts = entity.where("kind = 'person'").select("name_kind", F.col("form").alias("key"), "node", "full").where(~F.col("full"))
    tied = shorts.join(one, ["name_kind", "key"]).select(F.col("node").alias("src"), F.col("low").alias("dst"))

    said = nodes.where("kind = 'body' and acronym <> ''").select("name_kind", F.col("acronym").alias("key"), "node").distinct().join(entity.select("node", "entity"), "node").select("name_kind", "key", "entity")
    spelt = entity.where("kind = 'body' and length(initials) > 1").select("name_kind", F.col("initials").alias("key"), "entity")
    bodies = spelt.unionByName(said).groupBy("name_kind", "key").agg(F.min("entity").alias("low"), F.max("entity").alias("high")).where("low = high")
    acronyms = entity.where("kind = 'acronym'").select("name_kind", F.col("form").alias("key"), "node")
    called = acronyms.join(bodies, ["name_kind", "key"]).select(F.col("node").alias("src"), F.col("low").alias("dst"))

    groups = connected_components(links.unionByName(tied).unionByName(called)).withColumnRenamed("id", "node")
    return nodes.select("name_kind", "name", "node").join(groups, "node", "left").select("name_kind", "name", F.coalesce("group_id", "node").alias("entity"))


def variant_pairs(linked: DataFrame) -> DataFrame:
    """(name_kind, name_a, name_b) of all pairs of different strings of an entity, the smaller by code point first.

    The pairs are what is asked for; ``linked`` itself has a row per string. Entities of many strings are spread by the first of a pair.
    """
    a = linked.select("name_kind", "entity", F.col("name").alias("name_a"))
    b = linked.select(F.col("name_kind").alias("_kind"), "entity", F.col("name").alias("name_b"))
    pairs = skew_join(a, b, "entity", salt_by=F.col("name_a"))
    return pairs.where("name_kind = _kind and name_a < name_b").select("name_kind", "name_a", "name_b")
