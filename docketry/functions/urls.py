"""Urls, hosts and responses of sources."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def source_host(url: Column) -> Column:
    """Lower-case host without www., '(none)' where there is none; what follows a '|' in the url is a label."""
    bare = F.split_part(F.trim(F.coalesce(url, F.lit(""))), F.lit("|"), F.lit(1))
    host = F.regexp_extract(F.lower(bare), r"^(?:[a-z][a-z0-9+.-]*:)?(?://)?(?:[^/@]*@)?([^/:?#]+)", 1)
    return F.coalesce(F.nullif(F.regexp_replace(host, r"^www\.", ""), F.lit("")), F.lit("(none)"))


def url_label(url: Column) -> Column:
    """The label after '|', empty where there is none."""
    return F.split_part(F.coalesce(url, F.lit("")), F.lit("|"), F.lit(2))


def looks_like_pdf(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_replace(url, r"[?#].*$", "")).rlike(r"\.pdf$"), F.lit(False))


def looks_like_image(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_replace(url, r"[?#].*$", "")).rlike(r"\.(jpe?g|png|gif|bmp|tiff?|webp)$"), F.lit(False))


def has_pdf_signature(content: Column) -> Column:
    """'%PDF' within the first 1024 bytes of a binary column."""
    return F.contains(F.hex(F.substring(content, 1, 1024)), F.lit("25504446"))


def is_image_bytes(content: Column) -> Column:
    head = F.hex(F.substring(content, 1, 8))
    return head.rlike("^(FFD8FF|89504E47|47494638|424D|49492A00|4D4D002A)")


def host_allowed(host: Column, allow: list[str]) -> Column:
    """A listed host or a subdomain of one."""
    out = F.lit(False)
    for a in allow:
        out = out | (F.lower(host) == a.lower()) | F.lower(host).endswith("." + a.lower())
    return out


def url_violation(url: Column, allow: list[str]) -> Column:
    """Why a url may not be fetched: scheme, userinfo, port, private address or host; null where it may."""
    host = source_host(url)
    return (
        F.when(~F.coalesce(F.lower(url).rlike("^https?://"), F.lit(False)), "scheme")
        .when(url.rlike(r"^[a-zA-Z]+://[^/]*@"), "userinfo")
        .when(url.rlike(r"^[a-zA-Z]+://[^/:]+:(?!80(/|$)|443(/|$))[0-9]+"), "port")
        .when(host.rlike(r"^(localhost|127\.|10\.|192\.168\.|169\.254\.|172\.(1[6-9]|2[0-9]|3[01])\.)"), "private")
        .when(~host_allowed(host, allow), "host")
    )


def status_action(status: Column) -> Column:
    """What a status asks for: ok below 400, retire for 400, 401, 403, 404 and 410, else defer."""
    return F.when(status < 400, "ok").when(status.isin(400, 401, 403, 404, 410), "retire").otherwise("defer")


def backoff_seconds(attempts: Column) -> Column:
    """Seconds before the next attempt, doubling from 300 up to six doublings."""
    return F.least(F.lit(86400), (300 * F.pow(F.lit(2), F.least(F.greatest(attempts, F.lit(1)) - 1, F.lit(6)))).cast("int"))


def classify_response(status: Column, body: Column, url: Column) -> Column:
    """login, captcha, block, error, empty or ok."""
    low = F.lower(F.coalesce(body, F.lit("")))
    return (
        F.when(F.lower(F.coalesce(url, F.lit(""))).rlike("/login|/signin"), "login")
        .when(low.rlike("captcha|are you a robot"), "captcha")
        .when(low.rlike("already logged in|session (has )?expired"), "login")
        .when(status.isin(401, 403, 429) | low.rlike("access denied|too many requests"), "block")
        .when(status >= 400, "error")
        .when(F.length(F.trim(low)) == 0, "empty")
        .otherwise("ok")
    )


def html_to_text(html: Column) -> Column:
    """Visible text by an ordered chain of replacements: hidden and framing elements out, breaks to newlines, tags to blanks, entities back."""
    out = F.coalesce(html, F.lit(""))
    for tag in ("script", "style", "noscript", "header", "footer", "nav", "iframe"):
        out = F.regexp_replace(out, rf"(?is)<{tag}(\s[^>]*)?>.*?</{tag}\s*>", " ")
    out = F.regexp_replace(out, r"(?s)<!--.*?-->", " ")
    out = F.regexp_replace(out, r"(?i)<br\s*/?>|</p>|</div>|</tr>|</li>|</h[1-6]>", "\n")
    out = F.regexp_replace(out, r"(?s)<[^>]*>", " ")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        out = F.replace(out, F.lit(entity), F.lit(char))
    out = F.regexp_replace(out, r"[ \t]+", " ")
    out = F.regexp_replace(out, r" ?\n ?", "\n")
    return F.regexp_replace(F.regexp_replace(out, r"\n{3,}", "\n\n"), r"^\s+|\s+$", "")


def page_links(html: Column) -> Column:
    """(href, label) of every anchor of a page, in order."""
    return F.transform(
        F.regexp_extract_all(html, F.lit(r'(?is)(<a\s[^>]*href="[^"]*"[^>]*>.*?</a>)'), F.lit(1)),
        lambda a: F.struct(F.regexp_extract(a, r'(?is)href="([^"]*)"', 1).alias("href"), F.trim(F.regexp_replace(a, r"(?s)<[^>]*>", "")).alias("label")),
    )
