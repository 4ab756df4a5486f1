"""Labels for records, by the look and the place of their leaves.

They are training labels alone: the models learn from them, and it is the models that decide.
"""

from __future__ import annotations

import math
import re
from collections.abc import Container, Sequence
from functools import lru_cache

MAIN, SITE, RESIDUE = 0, 1, 2

# What sites put around their content.
SITE_WORDS = re.compile(r"all rights reserved|\bcookies?\b", re.I)
SITE_OPENINGS = re.compile(
    r"^(?:©.*|accept(?: all)?|settings|skip to main content|back to results|you are here:?.*|welcome,? guest.*"
    r"|home|search|help|login|log in|register|contact|contact us|careers|news|tenders|forms|downloads|gazette|judgments|statutes|feedback|site map|about us|cause list|bench roster|photo gallery|advanced search|صفحہ اول"
    r"|privacy policy|terms of use|disclaimer|refund policy|powered by.*|designed by.*|visitors: ?[\d,]+|best viewed at.*|last updated.*|print(?: this page)?|share|email|tweet|like|save as pdf|bookmark|a-|a|a\+"
    r"|sponsored\b.*|advertisement|article continues below|read also\b.*|listen to this.*|subscribe now.*|start your free trial|sign up to save.*|join our mailing list|get the mobile app|upgrade your plan.*"
    r"|find|all courts|« ?prev(?:ious)?|next ?»|home » .*|judgments (?:>|&gt;) .*"
    r"|[\w ]+ (?:law reports|legal archive|case library|gazette online)(?: \|.*)?)$",
    re.I,
)
SIDE_HEADS = re.compile(r"^(?:most read|recent judgments|related cases|you may also like|popular statutes|latest additions|latest judgments|see also|trending|in focus)\W*$", re.I)
COURT = re.compile(r"^(?:in the )?(?:[\w' ]+ (?:court|tribunal)(?: of [\w ]+| [A-Z]\w+)?|supreme court.*|federal shariat court.*)$", re.I)
CITATION = re.compile(r"^(?:PLD (?:18|19|20)\d\d [A-Za-z. ]+ \d+|(?:18|19|20)\d\d [A-Z][A-Za-z]{2,5} \d+)$")
TITLE = re.compile(r"^\S.{1,90} (?:v\.|vs\.?|versus) \S.{1,90}$", re.I)
COUNT = re.compile(r"^[\d,]+ (?:cases?|judgments?|results?|records?|entries) (?:found|listed)", re.I)
ACT = re.compile(r"^[\w() ]+ (?:act|ordinance|order|rules|regulations),? \d{4}$", re.I)

# What stands where content is missing.
TEMPLATE = re.compile(r"\bX{4,}\b|_{5,}|\{\{.*?\}\}|\{%.*?%\}|\[\[.*?\]\]|%[A-Z_]{3,}%|@@\w+@@|(?<!\w)#[a-z_]{3,}#|\[[\w ]+ here\]|<<.*?>>|\$\{.*?\}|__[A-Z_]+__|«\w+»|<[a-z][\w ]+>")
ERRORS = re.compile(
    r"\berror\b|not found|unavailable|\bdenied\b|forbidden|is blocked|timed out|too many requests|went wrong|maintenance|no longer (?:at|here)|try again|come back (?:after|later)|object reference|"
    r"\btrace:|incident [0-9a-f]+|help desk|wait a little|check the address|return to the list|session (?:has )?expired|bad gateway|could not be (?:loaded|reached|found|read)|exception|restricted to|error code|taken down|cannot be shown|failed to load|not available|start page|"
    r"^(?:error )?(?:40\d|50\d)\b|code (?:40\d|50\d)|in line \d+|at the moment|^oh no|^oops|request failed|did not respond|\bgateway\b|^ray [0-9a-f]+|code 4\d\d",
    re.I,
)
SCRIPTS = re.compile(r"java ?script|without js\b|\bscripting\b|enable scripts|scripts? (?:is|are) (?:off|disabled|required)|switch it on|turn on js|loading document|enable js|ad blocker|browser has blocked|scripts turned off|use another browser|allow(?:ed to run)? scripts|"
    r"press refresh|change the setting|checking your browser|active scripts|cannot run without", re.I)
FILLER = re.compile(
    r"lorem|ipsum|placeholder|dummy|sample (?:text|caption|title|heading)|asdf|qwer|^test(?: test)*$|coming soon|your (?:content|text) goes here|left (?:over|by)|theme demo|body copy|"
    r"do not publish|example title|write the summary|replace with|edit or delete|page design|checking the layout|remove before release|default (?:entry|headnote|title|order)|not for publication|"
    r"to be (?:filled|replaced)|goes in this|test (?:summary|headnote|caption|title|order)|example (?:summary|judgment|headnote|caption|order|entry)|filled in by",
    re.I,
)


# What a leaf, with a line end before it, must have in it for one of the patterns to be worth a search; plain strings are found much faster.
_SIGNS = [
    (TEMPLATE, ["xxxx", "_____", "{", "[", "%", "@@", "#", "<", "«", "__"]),
    (ERRORS, ["\n40", "\n50", "error", "not found", "unavailable", "denied", "forbidden", "blocked", "timed out", "too many", "went wrong", "maintenance", "no longer", "try again", "come back", "object reference", "trace:", "incident ", "help desk",
              "wait a", "check the", "return to", "expired", "gateway", "could not be", "exception", "restricted to", "taken down", "cannot be shown", "failed to", "not available", "start page", "code 4", "code 50", "in line ",
              "at the moment", "oh no", "oops", "request failed", "did not respond", "ray "]),
    (SCRIPTS, ["java", "without js", "script", "switch it", "turn on", "loading", "enable js", "ad blocker", "browser", "press refresh", "change the setting"]),
    (FILLER, ["lorem", "ipsum", "placeholder", "dummy", "sample ", "asdf", "qwer", "\ntest", "test summary", "test headnote", "test caption", "test title", "test order", "coming soon", "goes here", "left ", "theme", "body copy", "do not publish", "example ", "write the", "replace with", "edit or", "page design",
              "checking the", "remove before", "default ", "not for", "to be ", "goes in", "filled in"]),
]


def site_phrase(leaf: str) -> bool:
    low = leaf.lower()
    return bool(SITE_OPENINGS.match(leaf) or ("reserved" in low or "cookie" in low) and SITE_WORDS.search(leaf))


#: A line that stands in such a share of the texts (and in RECURS of them at least), nearly always in texts from sites, is what a site puts into all
#: of them. A share, since with the number of texts what cases have in common comes to stand in any given number of them by chance.
RECURS, RECURS_SHARE, OWN_SHARE, LEAST_WORDS = 4, 1 / 400, 0.9, 6


def least_recurring(texts: int) -> int:
    """In how many of so many texts a line must stand to be one that recurs."""
    return max(RECURS, math.ceil(RECURS_SHARE * texts))


def may_recur(line: str, inside: int, whole: int, least: int) -> bool:
    """Whether a line of several words recurs over texts in which something else is SITE already (inside), of all texts that have it (whole)."""
    return inside >= least and inside >= OWN_SHARE * whole and len(line.split()) >= LEAST_WORDS and not (COURT.match(line) or CITATION.match(line) or TITLE.match(line))


def free_lines(lines: list[str], labels: Sequence[int], sought: Container[str], frequent: Container[str]) -> set[str]:
    """The sought lines of a text that begin it, or follow site matter or a line that is not frequent.

    What a site puts in stands anywhere; a line that mostly stands behind another line that recurs, such as the heading of
    an order, belongs to how cases are written and is left as it is.
    """
    return {x for k, x in enumerate(lines) if x in sought and (k == 0 or labels[k - 1] == SITE or lines[k - 1] not in frequent)}


def recurs(free: int, whole: int) -> bool:
    """Whether a line that may recur is one a site puts in, by the number of texts in which it is free."""
    return 2 * free >= whole


def relabelled(lines: list[str], labels: Sequence[int], site_lines: Container[str]) -> list[int]:
    """The labels of the lines of a text with the lines that sites put in as SITE."""
    return [SITE if y == MAIN and x in site_lines else y for x, y in zip(lines, labels)]


#: Leaves up to so many characters are remembered with what the rules say of them. Only speed depends on it.
_MEMO_CHARS = 400


def is_site(leaf: str) -> bool:
    """Whether a leaf is a phrase or a side heading that sites put around their content."""
    return _brief_site(leaf) if len(leaf) <= _MEMO_CHARS else _site(leaf)


def residue_looks(leaves: list[str]) -> list[bool]:
    """Which leaves look like residue. The signs are sought in all of them at once, so that few are left to be sought in each."""
    whole = "\n".join(["", *leaves]).lower()
    signs = [(pattern, found) for pattern, signs in _SIGNS if (found := [x for x in signs if x in whole])]
    return [_looks(x, signs) for x in leaves]


def is_residue(leaf: str) -> bool:
    return _looks(leaf, _SIGNS)


def _looks(leaf: str, among: list[tuple[re.Pattern, list[str]]]) -> bool:
    low = f"\n{leaf.lower()}"
    brief = leaf.count(" ") < 24 or leaf[:1] in ("4", "5")  # an error notice is a line or two, or begins with its number
    for pattern, signs in among:
        if brief or pattern is not ERRORS:
            for x in signs:
                if x in low:
                    if pattern.search(leaf):
                        return True
                    break
    return False


def _site(leaf: str) -> bool:
    return site_phrase(leaf) or bool(SIDE_HEADS.match(leaf))


_brief_site = lru_cache(maxsize=200_000)(_site)


def prose_like(leaf: str, common: frozenset[str]) -> bool:
    words = re.findall(r"[^\W\d_]+", leaf.lower())
    return len(words) >= 6 and sum(w in common for w in words) >= 0.15 * len(words)


def latin_like(leaf: str, common: frozenset[str]) -> bool:
    """Many words, no function word of any language among them, and lower case: filler in a made-up language."""
    if len(leaf) < 15 or "," in leaf or "|" in leaf or any(w in common and w.isalpha() for w in leaf.lower().split()):
        return False
    words = re.findall(r"[^\W\d_]+", leaf)
    return len(words) >= 8 and not any(w.lower() in common for w in words) and sum(w.islower() for w in words) > 0.8 * len(words)


def label_lines(lines: list[str], common: frozenset[str]) -> list[int]:
    """MAIN or SITE for the lines of a text."""
    out, side = [], False
    web = any(site_phrase(x) for x in lines[:4])
    begun = not web
    for i, line in enumerate(lines):
        of_site = is_site(line)
        if of_site and SIDE_HEADS.match(line):
            side = True
            out.append(SITE)
            continue
        if side and (CITATION.match(line) or TITLE.match(line) or ACT.match(line)) and not (COURT.match(lines[i - 1]) if i else False):
            out.append(SITE)
            continue
        side = False
        if of_site and (web or len(line) > 12):
            out.append(SITE)
            continue
        begun = begun or bool(COURT.match(line)) or prose_like(line, common)
        out.append(MAIN if begun or TITLE.match(line) else SITE)
    return out


def label_page(leaves: list[tuple[str, tuple[str, ...], tuple[int, ...]]], common: frozenset[str]) -> list[int]:
    """MAIN or SITE for the leaves of a page: what shares the heading's container is main, inserts aside."""
    out = [SITE] * len(leaves)
    head = next((i for i, (_, path, _) in enumerate(leaves) if any(re.fullmatch(r"h[1-3](?:\..*)?", t) for t in path[-2:])), None)
    if head is None:
        head = next((i for i, (x, path, _) in enumerate(leaves) if path and path[-1] in ("b", "strong") and (TITLE.match(x) or ACT.match(x) or i + 1 < len(leaves) and (CITATION.match(leaves[i + 1][0]) or COUNT.match(leaves[i + 1][0])))), None)
    if head is None:
        return [MAIN if prose_like(x, common) and not site_phrase(x) else SITE for x, _, _ in leaves]
    ids = leaves[head][2]
    box = ids[-2] if len(ids) > 1 else 0
    side = False
    for i, (x, path, around) in enumerate(leaves):
        if i < head or (box and box not in around):
            continue
        if any(t.split(".")[0] in ("aside", "nav", "footer", "form", "header", "small") or t.endswith(".x") for t in path):
            continue
        if SIDE_HEADS.match(x):
            side = True
        if (side and i > head) or (site_phrase(x) and i > head) or (re.fullmatch(r"\d{1,3}", x) and path[-1:] == ("a",)):
            continue
        out[i] = MAIN
    return out


def label_record(leaves: list[str], placed: list[int], common: frozenset[str]) -> list[int] | None:
    """MAIN, SITE or RESIDUE for the leaves of one record; None where the record is no clear example.

    A record is an example of residue if most of its text besides site matter looks like residue and none of it like
    a case; then all of that text is residue, phrases included that no pattern knows. It is an example of content
    if nothing in it looks like residue.
    """
    looks = [r or latin_like(x, common) for r, x in zip(residue_looks(leaves), leaves)]
    known = [is_site(x) for x in leaves]
    if not any(r and not k for r, k in zip(looks, known)):
        return list(placed)
    case = any(not r and (prose_like(x, common) or COURT.match(x) and len(x) < 60) for x, r in zip(leaves, looks))
    open_ = sum(len(x) for x, k, y, r in zip(leaves, known, placed, looks) if not k and (y == MAIN or r and is_residue(x)))
    hit = sum(len(x) for x, k, r in zip(leaves, known, looks) if r and not k)
    if case or hit < 0.5 * open_:
        return None
    side = False
    out = []
    for x, k, r in zip(leaves, known, looks):
        side = bool(SIDE_HEADS.match(x)) or (side and bool(CITATION.match(x) or TITLE.match(x) or ACT.match(x)))
        out.append(RESIDUE if r and not k else SITE if k or side or CITATION.match(x) or TITLE.match(x) else RESIDUE)
    return out
