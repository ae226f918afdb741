"""URL filtering with rules indexed by their rarest literal token.

Every rule becomes a regular expression and, where it has one, is filed under the literal token of it that
the fewest URLs hold. A URL's tokens fetch the rules filed under them, and only those expressions are run.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from granary.llm.common import LOWER, UPPER, pick, table

TOKEN = re.compile(r"[a-z0-9]+")
_SEPARATOR = r"(?:[^a-z0-9_.%-]|$)"


@dataclass(frozen=True)
class SiteRule:
    """Fits a host and its subdomains where the path starts with `path`; the longest that fits decides."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    @property
    def regex(self) -> str:
        return rf"^(?:[^\n]*\.)?{re.escape(self.host)}\n{re.escape(self.path)}"

    def tokens(self) -> set[str]:
        whole = TOKEN.findall(self.host.lower())
        runs = [(m.group(), m.end()) for m in TOKEN.finditer(self.path.lower())]
        return {*whole, *(t for t, end in runs if end < len(self.path))}


@dataclass(frozen=True)
class PatternRule:
    """Fits a lower-cased URL: `*` stands for anything, `^` for a separator or the end, `|` at an end for that end."""

    verdict: str
    pattern: str

    @property
    def regex(self) -> str:
        body, front, back = self.pattern, "", ""
        if body.startswith("|"):
            body, front = body[1:], "^"
        if body.endswith("|"):
            body, back = body[:-1], "$"
        special = {"*": ".*", "^": _SEPARATOR}
        return front + "".join(special.get(c) or re.escape(c) for c in body) + back

    def tokens(self) -> set[str]:
        """Tokens that are whole in every URL that fits: not beside `*` or an open end."""
        p = self.pattern.lower()
        return {m.group() for m in TOKEN.finditer(p) if m.start() > 0 and p[m.start() - 1] != "*" and m.end() < len(p) and p[m.end()] != "*"}


#: The five rules of the contract; the longest that fits decides.
SITE_RULES = (
    SiteRule("allow", "com", "/"),
    SiteRule("block", "example.com", "/en/"),
    SiteRule("allow", "www.example.com", "/en/"),
    SiteRule("block", "net", "/es/"),
    SiteRule("block", "net", "/fr/"),
)
#: What the method itself says of a URL that no site rule fits: block where a block pattern fits and no allow pattern, else allow.
PATTERN_RULES = (
    PatternRule("block", "^utm_source=feed^"),
    PatternRule("block", "^utm_campaign=*"),
    PatternRule("block", "/ads/*"),
    PatternRule("block", "/banner/*"),
    PatternRule("block", "^affiliate=*"),
    PatternRule("block", "/wp-login.php^"),
    PatternRule("block", "/cart/*"),
    PatternRule("block", "|ftp:"),
    PatternRule("allow", "/robots.txt|"),
    PatternRule("allow", "/sitemap.xml^"),
)


def _ascii_lower(s: str) -> str:
    return s.translate(_LOWERED)


_LOWERED = str.maketrans(UPPER, LOWER)


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty for null and for a URL without ://."""
    start = -1 if url is None else url.find("://")
    if start < 0:
        return "", ""
    rest = re.split(r"[?#]", url[start + 3 :], maxsplit=1)[0]
    host, slash, path = rest.partition("/")
    return _ascii_lower(host), slash + path


class RuleIndex:
    """Rules by their rarest token. counts: in how many URLs each token stands."""

    def __init__(self, sites, patterns, counts: dict[str, int]):
        self.by_token, self.always = defaultdict(list), []
        for rule in (*sites, *patterns):
            tokens = rule.tokens()
            entry = (rule, re.compile(rule.regex, re.DOTALL), isinstance(rule, SiteRule))
            if tokens:
                self.by_token[min(tokens, key=lambda t: (counts.get(t, 0), -len(t), t))].append(entry)
            else:
                self.always.append(entry)

    def judge(self, url: str | None) -> tuple[str, str, str | None, str, int]:
        """host, path, site rule or None, verdict, expressions run."""
        host, path = split_url(url)
        low = _ascii_lower(url or "")
        site, said, run = None, set(), 0
        candidates = [e for t in set(TOKEN.findall(low)) for e in self.by_token.get(t, ())]
        for rule, regex, is_site in (*candidates, *self.always):
            if is_site and site is not None and len(rule.text) <= len(site.text):
                continue
            run += 1
            if regex.search(f"{host}\n{path}" if is_site else low):
                if is_site:
                    site = rule
                else:
                    said.add(rule.verdict)
        own = "block" if "block" in said and "allow" not in said else "allow"
        return host, path, site and site.text, site.verdict if site else own, run


def token_counts(urls: DataFrame, vocabulary: set[str]) -> dict[str, int]:
    """In how many URLs each token of the rules stands. The result is no larger than the rule list."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n: Counter = Counter()
        for batch in batches:
            for url in batch["url"]:
                n.update(vocabulary.intersection(TOKEN.findall(_ascii_lower(url or ""))))
        if n:  # an empty partition has no frame whose types Arrow could read
            yield pd.DataFrame({"token": list(n), "n": list(n.values())})

    found = urls.mapInPandas(count, "token string, n long").groupBy("token").sum("n").collect()
    return dict(map(tuple, found))


def filter_urls(df: DataFrame, id_col: str = "page_id", url_col: str = "url", sites=SITE_RULES, patterns=PATTERN_RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, n_regex (expressions run) for each input row.

    A null URL, an empty one and one without :// have an empty host and path and fit no site rule; the patterns
    still judge what text there is. Repeated rows and null ids give a row each; equal lengths cannot tie, as a
    host has one rule of each length that fits. Other columns are ignored; an empty table gives no rows.
    """
    urls = pick(df, id_col, url_col).toDF("page_id", "url")
    vocabulary = set().union(*(r.tokens() for r in (*sites, *patterns)))
    index = RuleIndex(sites, patterns, token_counts(urls.select("url"), vocabulary))
    id_type = urls.schema["page_id"].dataType.simpleString()

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in filter(len, batches):
            found = pd.DataFrame([index.judge(u) for u in batch["url"]], columns=["host", "path", "rule", "verdict", "n_regex"])
            yield pd.concat([batch["page_id"].reset_index(drop=True), found], axis=1)

    return urls.mapInPandas(judge, f"page_id {id_type}, host string, path string, rule string, verdict string, n_regex int")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages")).drop("n_regex")


def _sql() -> str:
    q = lambda s: "'" + s.replace("'", "''") + "'"
    fits = lambda r: f"((host = {q(r.host)} OR ends_with(host, {q('.' + r.host)})) AND starts_with(path, {q(r.path)}))"
    longest = sorted(SITE_RULES, key=lambda r: -len(r.text))
    rule = "CASE " + " ".join(f"WHEN {fits(r)} THEN {q(r.text)}" for r in longest) + " END"
    verdict = "CASE rule " + " ".join(f"WHEN {q(r.text)} THEN {q(r.verdict)}" for r in longest) + " ELSE own END"
    some = lambda v: "(" + " OR ".join(f"regexp_matches(low, {q(r.regex)}, 's')" for r in PATTERN_RULES if r.verdict == v) + ")"
    return f"""
WITH u AS (SELECT page_id, coalesce(url, '') AS url FROM pages),
s AS (SELECT page_id, translate(url, '{UPPER}', '{LOWER}') AS low,
  translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), '{UPPER}', '{LOWER}') AS host,
  regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path FROM u),
r AS (SELECT page_id, host, path, {rule} AS rule,
  CASE WHEN {some("block")} AND NOT {some("allow")} THEN 'block' ELSE 'allow' END AS own FROM s)
SELECT page_id, host, path, rule, {verdict} AS verdict FROM r
"""


OP10_SQL = _sql()
