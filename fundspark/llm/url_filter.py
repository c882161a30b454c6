"""URL filter rules found through an index of their rarest literal token.

A pattern is written ``/login/``, ``||shop.example.com^``, ``?ref=*&`` and so on: ``||`` ties it to
the start of the host or of one of its labels, ``^`` stands for a separator or the end, ``*`` for
anything, the rest is literal (letters of either case). A leading ``@@`` makes it an exception,
which wins over blocking rules.

Only a run of letters and digits that stands between separators of the pattern must appear in a
matching URL as a whole token. Each rule is filed under the one of these that the fewest URLs hold;
a URL's tokens fetch the rules filed under them, and only those run their regular expression. Rules
without such a token are run on every URL. Everything is one projection over the URLs: the
index is a constant array of hash slots in the plan, so nothing is shuffled and no row is grouped.

Defined results: a null URL, or one without ``://``, has an empty host and path, no rule and the
method's verdict on the text as it stands (a null URL is allowed). Repeated rows are judged alike,
an empty table gives an empty table, and columns other than those named are neither read nor
changed.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_RULES = 10_000  # the index is part of the plan
PATTERNS = (
    "||ads.", "||ad.", "||track.", "||login.", "/login/", "/signin/", "/logout/", "/cart/", "/checkout/", "/admin/",
    "/wp-login.php", "/search?", "/print/", "/feed/", "/tag/", "?share=", "&replytocom=", "utm_source=", "utm_medium=",
    "sessionid=", "/ads/*", "/banner/", ".exe^", ".zip^", ".pdf^", "page=*&ref=", "||m.*.net^en/", "@@||blog.",
    "@@/about/", "/fr/*#top",
)
HOST_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def pattern_regex(pattern: str) -> str:
    """The regular expression of a pattern, for Java and RE2 alike."""
    body, head = pattern.removeprefix("@@"), "(?i)"
    if body.startswith("||"):
        body, head = body[2:], r"(?i)^[a-z][a-z0-9+.-]*://([^/?#]*\.)?"
    special = {"*": ".*", "^": "([^A-Za-z0-9_.%-]|$)"}
    return head + "".join(special.get(c, c if c.isalnum() or c in "/=&_%:,;@~!#'\"<> " else "\\" + c) for c in body)


def pattern_tokens(pattern: str) -> list[str]:
    """Runs of letters and digits that every matching URL holds as a whole token."""
    body = pattern.removeprefix("@@")
    anchored = body.startswith("||")
    body = body.removeprefix("||")
    found = []
    for m in re.finditer(r"[A-Za-z0-9]+", body):
        left = body[m.start() - 1] if m.start() else ("^" if anchored else "*")
        right = body[m.end()] if m.end() < len(body) else "*"
        if "*" not in (left, right):
            found.append(m.group().lower())
    return found


def url_tokens(url: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(url), "[^a-z0-9]+"), lambda t: t != ""))


def file_rules(urls: DataFrame, url: str, patterns: tuple[str, ...]) -> dict[str, list[str]]:
    """Patterns by the literal token that the fewest URLs hold; '' for those that have none.
    Counts the rules' own tokens over all URLs: at most one row per token comes back."""
    if len(patterns) > MOST_RULES:
        raise ValueError(f"{len(patterns)} patterns; the index takes at most {MOST_RULES}")
    wanted = sorted({t for p in patterns for t in pattern_tokens(p)})
    held: dict[str, int] = {}
    if wanted:
        hit = F.array_intersect(url_tokens(F.col(url)), F.array(*map(F.lit, wanted)))
        counts = urls.select(F.explode(hit).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
        held = {r["token"]: r["n"] for r in counts.collect()}
    filed: dict[str, list[str]] = {}
    for p in patterns:
        rarest = min(((held.get(t, 0), t) for t in pattern_tokens(p)), default=(0, ""))[1]
        filed.setdefault(rarest, []).append(p)
    return filed


def matching(url: Column, filed: dict[str, list[str]]) -> Column:
    """Array of struct(exception, pattern) of the rules that the URL matches."""
    kind = "array<struct<token:string,regex:string,exception:boolean,pattern:string>>"

    def entries(token: str) -> list[Column]:
        return [
            F.struct(F.lit(token).alias("token"), F.lit(pattern_regex(p)).alias("regex"),
                     F.lit(p.startswith("@@")).alias("exception"), F.lit(p).alias("pattern"))
            for p in filed.get(token, [])
        ]

    tokens = [t for t in filed if t]
    count = max(1, 2 * len(tokens))
    slots: list[list[Column]] = [[] for _ in range(count)]
    for t in tokens:
        slots[token_slot(t, count)] += entries(t)
    index = F.array(*[F.array(*s).cast(kind) if s else F.array().cast(kind) for s in slots])
    always = F.array(*entries("")).cast(kind) if filed.get("") else F.array().cast(kind)

    def fetched(token: Column) -> Column:
        bucket = F.get(index, F.pmod(F.crc32(token.cast("binary")), F.lit(count)).cast("int"))
        return F.filter(bucket, lambda r: r["token"] == token)

    candidates = F.concat(always, F.flatten(F.transform(url_tokens(url), fetched)))
    return F.filter(candidates, lambda r: F.call_function("rlike", url, r["regex"]))


def token_slot(token: str, count: int) -> int:
    import zlib

    return zlib.crc32(token.encode()) % count


def host_path(url: Column) -> tuple[Column, Column]:
    known = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    host = F.translate(
        F.regexp_extract(rest, "^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    )
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.when(known, host).otherwise(F.lit("")), F.when(known, path).otherwise(F.lit(""))


def longest_rule(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...]) -> Column:
    """struct(verdict, rule) of the longest rule whose host is the URL's or one above it and whose
    path starts the URL's; null if none."""
    chosen = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        chosen = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(h + p).alias("rule"))).otherwise(chosen)
    return chosen


def filter_urls(
    pages: DataFrame,
    url: str = "url",
    key: str = "page_id",
    patterns: tuple[str, ...] = PATTERNS,
    host_rules: tuple[tuple[str, str, str], ...] = HOST_RULES,
) -> DataFrame:
    """One row per input row: key, host, path, rule, verdict, and the patterns that matched."""
    filed = file_rules(pages, url, patterns)
    host, path = host_path(F.col(url))
    found = pages.select(F.col(key), F.col(url).alias("_url"), host.alias("host"), path.alias("path")).select(
        F.col(key), "host", "path",
        longest_rule(F.col("host"), F.col("path"), host_rules).alias("_rule"),
        F.coalesce(matching(F.col("_url"), filed), F.array().cast("array<struct<token:string,regex:string,exception:boolean,pattern:string>>")).alias("_hits"),
    )
    blocked = (F.size("_hits") > 0) & ~F.exists("_hits", lambda r: r["exception"])
    method = F.when(blocked, F.lit("block")).otherwise(F.lit("allow"))
    return found.select(
        F.col(key), "host", "path",
        F.col("_rule.rule").alias("rule"),
        F.coalesce(F.col("_rule.verdict"), method).alias("verdict"),
        F.array_sort(F.array_distinct(F.transform("_hits", lambda r: r["pattern"]))).alias("matched"),
    )


def url_filter_sql(table: str = "pages", patterns=PATTERNS, host_rules=HOST_RULES) -> str:
    """The same verdicts as plain SQL that runs every rule on every URL (``matched`` left out)."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    any_of = lambda ps: " OR ".join(f"regexp_matches(url, {quoted(pattern_regex(p))})" for p in ps) or "FALSE"
    blocks = any_of([p for p in patterns if not p.startswith("@@")])
    exceptions = any_of([p for p in patterns if p.startswith("@@")])
    fits = [
        (f"(host = {quoted(h)} OR ends_with(host, {quoted('.' + h)})) AND starts_with(path, {quoted(p)})", v, h + p)
        for v, h, p in sorted(host_rules, key=lambda r: -len(r[1] + r[2]))
    ]
    rule = "CASE " + " ".join(f"WHEN {f} THEN {quoted(r)}" for f, _, r in fits) + " END"
    verdict = "CASE " + " ".join(f"WHEN {f} THEN {quoted(v)}" for f, v, _ in fits) + " END"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH cut AS (
  SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM {table}
), parts AS (
  SELECT page_id, url, coalesce(translate(regexp_extract(rest, '^[^/?#]*', 0), '{upper}', '{lower}'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM cut
)
SELECT page_id, host, path, {rule} AS rule,
       coalesce({verdict}, CASE WHEN coalesce(({blocks}) AND NOT ({exceptions}), FALSE) THEN 'block' ELSE 'allow' END) AS verdict
FROM parts"""
