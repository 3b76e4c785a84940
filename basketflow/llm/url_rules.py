"""URL filters: pattern rules indexed by their rarest literal token.

Every rule is a regular expression over ``host + path`` plus the literal
tokens that any URL it matches must contain.  Token frequencies are counted
over all URLs; each rule is filed under its rarest token only.  A URL looks up
its own tokens in that index and runs just the expressions it finds there.

The longest site rule that fits decides; without one, a matching block
pattern blocks, and everything else is allowed.  A null URL, or one without
``://``, has an empty host and path and is allowed.  Output columns replace
input columns of the same name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketflow.llm.common import fresh, strings, with_fields

MAX_RULES = 1_000_000      # the index is broadcast: a larger rule set is refused

# The site rules (verdict, host, path) and blocked host words.
SITE_RULES = (
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"), ("block", "com", "/de/"),
)
BLOCKED_WORDS = ("casino", "poker", "bets", "betting", "jackpot", "pills", "viagra", "porn", "xxx", "escort", "payday",
                 "warez", "torrent")

TOKEN = re.compile(r"[a-z0-9]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@dataclass(frozen=True)
class UrlRule:
    name: str
    verdict: str               # allow or block
    pattern: str               # matched against host + path
    tokens: tuple[str, ...]    # literal tokens of every URL that matches (lower case)
    site: bool


def site_rule(verdict: str, host: str, path: str) -> UrlRule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""
    whole = path[:len(path) - len(re.search(r"[A-Za-z0-9]*$", path)[0])]   # a cut-off last token is no literal
    return UrlRule(host + path, verdict, r"^(?:[^/]*\.)?" + re.escape(host) + r"(?=/|$)" + (re.escape(path) if path else ""),
                   tuple(TOKEN.findall((host + " " + whole).lower())), True)


def word_rule(word: str) -> UrlRule:
    """Blocks hosts with ``word`` between dots or hyphens."""
    return UrlRule(word, "block", r"^(?:[^/]*[.-])?" + re.escape(word) + r"(?:[.-][^/]*)?(?:/|$)", (word,), False)


def rules() -> list[UrlRule]:
    return [site_rule(*r) for r in SITE_RULES] + [word_rule(w) for w in BLOCKED_WORDS]


def split_url(url: str | None) -> tuple[str, str]:
    """(host with A-Z in lower case, path); both empty without ``://``."""
    at = -1 if url is None else url.find("://")
    if at < 0:
        return "", ""
    rest = re.split(r"[?#]", url[at + 3:], maxsplit=1)[0]
    slash = rest.find("/")
    host, path = (rest, "") if slash < 0 else (rest[:slash], rest[slash:])
    return host.translate(_LOWER), path


def token_counts(urls: Column, df: DataFrame, wanted: list[str]) -> dict[str, int]:
    """In how many URLs each wanted token occurs (at most one row per wanted token comes back)."""
    toks = F.array_intersect(F.regexp_extract_all(F.lower(urls), F.lit("[a-z0-9]+"), 0),
                             F.array(*[F.lit(w) for w in wanted]))
    got = df.select(F.explode(toks).alias("t")).groupBy("t").count().collect()
    return {r["t"]: r["count"] for r in got}


def build_index(todo: list[UrlRule], counts: dict[str, int]) -> dict[str, list[UrlRule]]:
    """token -> rules filed under it; rules without a literal token are filed under ''."""
    index: dict[str, list[UrlRule]] = {}
    for r in todo:
        rarest = min(r.tokens, key=lambda t: (counts.get(t, 0), t)) if r.tokens else ""
        index.setdefault(rarest, []).append(r)
    return index


class Judge:
    def __init__(self, index: dict[str, list[UrlRule]]):
        self.index = {t: [(re.compile(r.pattern), r) for r in rs] for t, rs in index.items()}

    def judge(self, url: str | None) -> tuple[str, str, str | None, str]:
        host, path = split_url(url)
        text = host + path
        best, blocked = None, False
        for token in {"", *TOKEN.findall(text.lower())}:
            for pattern, r in self.index.get(token, ()):
                if pattern.search(text):
                    if not r.site:
                        blocked = blocked or r.verdict == "block"
                    elif best is None or (len(r.name), r.name) > (len(best.name), best.name):
                        best = r
        if best is not None:
            return host, path, best.name, best.verdict
        return host, path, None, "block" if blocked else "allow"


def judge_urls(df: DataFrame, url_col: str = "url", todo: list[UrlRule] | None = None) -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict``."""
    todo = rules() if todo is None else todo
    if len(todo) > MAX_RULES:
        raise ValueError(f"{len(todo)} rules exceed the broadcast bound of {MAX_RULES}")
    url = F.col(f"`{url_col}`").cast("string")
    wanted = sorted({t for r in todo for t in r.tokens})
    index = build_index(todo, token_counts(url, df, wanted) if wanted else {})
    shared = df.sparkSession.sparkContext.broadcast(index)
    new = ("host", "path", "rule", "verdict")
    schema = with_fields(df.schema, [T.StructField(c, T.StringType()) for c in new])
    carried = [c for c in schema.names if c not in new]
    given = fresh(df, "url_in")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        j = Judge(shared.value)
        for batch in batches:
            got = [j.judge(u) for u in strings(batch.column(given))]
            cols = [pa.array([g[k] for g in got], pa.string()) for k in range(4)]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in carried] + cols, names=schema.names)

    return df.select(*[F.col(f"`{c}`") for c in carried], url.alias(given)).mapInArrow(run, schema)
