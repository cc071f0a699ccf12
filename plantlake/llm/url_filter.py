"""URL filter: a trie over reversed host labels, then path segments, with longest-match precedence.

Rules are (verdict, host, path).  A rule fits its host and all subdomains if
the url's path starts with the rule's path; the longest rule text (host plus
path) wins, and of equally long ones that with more host labels.  The host
part of the trie is walked from the last label; every node may hold a path
trie whose edges are whole segments and whose nodes hold the beginnings of
the next segment.  A url's cost depends on its own labels and segments, and
on the lengths of the beginnings that rules name there; it is linear in the
url's length.

The trie is broadcast; its size is bounded by ``MAX_RULES`` (checked when it
is built).  Spark part: a map over the url column alone.

Edge cases: a null url, or one without ``://``, has an empty host and path and
no rule, and is blocked as malformed; any other url without a rule gets
``default``; repeated rows are each judged; urls are taken whole, however
long; an empty table gives an empty one; only the url column is read, so
other columns may have any names but ``into``.
"""

from __future__ import annotations

from bisect import insort
from operator import neg

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_RULES = 1_000_000
#: The contract's rules.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
DEFAULT, MALFORMED = "allow", "block"
_LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def build_trie(rules) -> dict:
    """Nested dicts: host node {"next": {label: node}, "path": path node or None};
    path node {"next": {segment: node}, "starts": {beginning of the next segment: rule},
    "lengths": lengths of these beginnings, longest first}."""
    rules = list(rules)
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; the broadcast trie takes at most {MAX_RULES}")
    root = {"next": {}, "path": None}
    for verdict, host, path in rules:
        node = root
        for label in reversed(host.split(".")):
            node = node["next"].setdefault(label, {"next": {}, "path": None})
        if node["path"] is None:
            node["path"] = {"next": {}, "starts": {}, "lengths": [], "all": None}
        at = node["path"]
        rule = (len(host) + len(path), host + path, verdict)
        if not path:
            at["all"] = rule
            continue
        *whole, start = path.split("/")[1:]
        for segment in whole:
            at = at["next"].setdefault(segment, {"next": {}, "starts": {}, "lengths": [], "all": None})
        at["starts"][start] = rule
        if len(start) not in at["lengths"]:
            insort(at["lengths"], len(start), key=neg)
    return root


def _path_rule(at: dict, path: str):
    best = at["all"]
    if not path.startswith("/"):
        return best
    segments = path.split("/")[1:]
    for i, segment in enumerate(segments):
        for n in at["lengths"]:
            if n <= len(segment) and (rule := at["starts"].get(segment[:n])) is not None:
                best = rule if best is None or rule[0] > best[0] else best
                break
        at = at["next"].get(segment) if i < len(segments) - 1 else None
        if at is None:
            break
    return best


def find_rule(trie: dict, host: str, path: str):
    """(length, rule text, verdict) of the winning rule, or None."""
    best, node = None, trie
    for label in reversed(host.split(".")):
        node = node["next"].get(label)
        if node is None:
            break
        if node["path"] is not None and (rule := _path_rule(node["path"], path)) is not None:
            if best is None or rule[0] >= best[0]:
                best = rule
    return best


def split_url(url: str | None) -> tuple[str, str]:
    """(host with A-Z lower-cased, path) of a url; both empty without ``://``."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    end = min((i for c in "?#" if (i := rest.find(c)) >= 0), default=len(rest))
    host, slash, path = rest[:end].partition("/")
    return host.translate(_LOWER), slash + path


def filter_urls(pages: DataFrame, *, url_col: str = "url", rules=RULES, default: str = DEFAULT,
                into: str = "url_verdict") -> DataFrame:
    """``pages`` with a struct ``into`` (a new name): host, path, rule, verdict."""
    shared = pages.sparkSession.sparkContext.broadcast(build_trie(rules))

    @F.arrow_udf("struct<host:string,path:string,rule:string,verdict:string>")
    def judge(urls: pa.Array) -> pa.Array:
        trie, out = shared.value, []
        for url in urls.to_pylist():
            host, path = split_url(url)
            rule = find_rule(trie, host, path)
            verdict = rule[2] if rule else default if host else MALFORMED
            out.append((host, path, rule and rule[1], verdict))
        cols = list(zip(*out)) or [()] * 4
        return pa.StructArray.from_arrays([pa.array(c, pa.string()) for c in cols],
                                          ["host", "path", "rule", "verdict"])

    return pages.withColumn(into, judge(F.col(url_col)))
