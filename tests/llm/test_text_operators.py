"""Map-only operators against brute force, and their edge cases."""
import hashlib
import random
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plantlake.llm import queries as Q
from plantlake.llm.decontaminate import WuManber, decontaminate
from plantlake.llm.license_scan import TEMPLATES, scan_licenses
from plantlake.llm.quality_rules import judge
from plantlake.llm.secret_scan import BASE_RULES, RULES, Scanner, redact_secrets, scan_secrets
from plantlake.llm.url_filter import RULES as URL_RULES
from plantlake.llm.url_filter import build_trie, filter_urls, find_rule, split_url

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, source string, items string, spans string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def frame(spark, rows, schema=DOCS):
    width = len(schema.split(","))
    return spark.createDataFrame([tuple(r) + (None,) * (width - len(r)) for r in rows], schema)


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def naive_contamination(text, items, n=13):
    ws, hit, found = words(text), set(), set()
    for item, item_text in items:
        iw = words(item_text)
        for i in range(max(len(iw) - n, 0) + 1 if iw else 0):
            win = iw[i:i + n]
            for at in range(len(ws) - len(win) + 1):
                if ws[at:at + len(win)] == win:
                    hit.update(range(at, at + len(win)))
                    found.add(item)
    return len(ws), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(ws)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab ", min_size=1, max_size=12), min_size=1, max_size=8), st.text("ab ", max_size=200))
def test_wu_manber_finds_every_occurrence(patterns, text):
    patterns = sorted({p.encode() for p in patterns})
    text = text.encode()
    want = {(i, k) for k, p in enumerate(patterns) for i in range(len(text)) if text.startswith(p, i)}
    assert sorted(WuManber(patterns).find(text)) == sorted(want)


ITEMS = [(1, " ".join(f"w{i}" for i in range(30))), (2, "Short Item"), (3, None), (4, "..."), (2, "Short Item"),
         (None, "no id here"), (5, " ".join(f"w{i}" for i in range(5, 25)))]
CASES = [
    (1, " ".join(f"w{i}" for i in range(30))), (2, "x short, ITEM! " * 3), (3, None), (4, ""), (5, "!!! ..."),
    (6, "w3 w4 " + " ".join(f"w{i}" for i in range(5, 18)) + " y" * 400), (7, "has no id here at all"),
    (1, " ".join(f"w{i}" for i in range(30))), (8, "É short\x00item 9 " + "z " * 50_000 + "short item"),
    (None, "short item"),
]


@pytest.mark.parametrize("block_bytes", [16 << 20, 200])
def test_decontamination_equals_brute_force(spark, block_bytes):
    docs = frame(spark, CASES)
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    got = sorted(((r["doc_id"], r["x"]["n_words"], r["x"]["n_hit"], r["x"]["items"], r["x"]["contaminated"])
                  for r in decontaminate(docs, items, into="x", block_bytes=block_bytes).collect()), key=str)
    want = []
    for doc_id, text in CASES:
        n, hit, _, bad = naive_contamination(text, ITEMS)
        ids = naive_contamination(text, [i for i in ITEMS if i[0] is not None])[2]
        want.append((doc_id, n, hit, ids, bad))
    assert got == sorted(want, key=str)


def test_decontamination_of_empty_tables(spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert [r["x"]["contaminated"] for r in decontaminate(frame(spark, [(1, "a b")]), none, into="x").collect()] == [False]
    assert decontaminate(frame(spark, []), none, into="x").count() == 0


BASE = {
    "assign": re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I),
    "access": re.compile(rb"AKIA[A-Z0-9]+"),
    "hex": re.compile(rb"[0-9a-f]+"),
}


def naive_spans(data):
    out = []
    for k, rule in enumerate(BASE_RULES):
        for m in BASE[rule.kind].finditer(data):
            if len(m[2] if rule.kind == "assign" else m[0]) >= rule.least:
                out.append((m.start(), k, m.end()))
    return sorted(out)


PIECES = ["password", "PassWd", "token", "api_key", "apikey", "secret", "=", ":", " ", "  ", '"', "'", "AKIA", "ABCD1234",
          "0123456789abcdef", "deadbeef", "x", "-", "é", "\n", "KEY", "token=", "q" * 12, "eyJ", ".", "ghp_", "xoxb-"]


def test_automaton_equals_regular_expressions():
    scan = Scanner(BASE_RULES)
    rng = random.Random(5)
    for _ in range(4000):
        data = "".join(rng.choices(PIECES, k=rng.randrange(1, 25))).encode()
        assert scan.spans(data) == naive_spans(data), data


def test_added_rules_keep_the_base_spans():
    scan, rng = Scanner(RULES), random.Random(6)
    for _ in range(1500):
        data = "".join(rng.choices(PIECES, k=rng.randrange(1, 25))).encode()
        assert [s for s in scan.spans(data) if s[1] < 3] == naive_spans(data)
    text = b"-----BEGIN RSA PRIVATE KEY----- ghp_" + b"A" * 36 + b" xoxb-12345-abcdefghij eyJhbGciOi.eyJzdWIiOiIx.c2lnbmF0dXJlLXg"
    assert [RULES[k].kind for _, k, _ in scan.spans(text)] == ["private_key", "code_host", "chat", "jwt"]


def test_private_key_body_and_long_hostile_texts():
    scan = Scanner(RULES)
    key = b"-----BEGIN RSA PRIVATE KEY-----\nMIIEow+/A=\r\nabc\n-----END RSA PRIVATE KEY-----"
    kinds = lambda data: [(RULES[k].kind, data[s:e]) for s, k, e in scan.spans(data)]
    assert kinds(b"x " + key + b" y " + key) == [("private_key", key)] * 2
    cut = key[:key.index(b"-----END")]  # no closing line: the opening line alone
    assert kinds(cut + b" and more text") == [("private_key", b"-----BEGIN RSA PRIVATE KEY-----")]
    # Starts that fail far away, 1 MB of them: linear, so a few seconds; restarting at each took hours.
    hostile = b"token=" + b"eyJ" * 350_000 + b"..eyJa.b." + b"z" * 40
    begun = time.monotonic()
    got = kinds(hostile)
    assert time.monotonic() - begun < 60
    assert [k for k, _ in got] == ["assign", "jwt"] and got[1][1] == b"eyJa.b." + b"z" * 40


def test_rules_match_a_backtracking_engine():
    """Spans of all rules against another engine's leftmost matches, tried longest first."""
    scan, rng = Scanner(RULES), random.Random(11)
    bits = [b"token=", b"eyJ", b".", b"a", b"AKIA", b"0123456789abcdef", b" ", b"'", b"ghp_", b"XXXXXXXX9", b"xoxb-",
            b"-----BEGIN ", b"PRIVATE KEY-----", b"-----END ", b"secret : ", b"-", b"\n"]
    for _ in range(300):
        data, want = b"".join(rng.choices(bits, k=rng.randrange(1, 12))), []
        for k, rule in enumerate(RULES):
            flags = re.IGNORECASE if rule.any_case else 0
            whole, head = re.compile(rule.pattern.encode(), flags), rule.head and re.compile(rule.head.encode(), flags)
            longest = lambda p, at, end: next((e for e in range(end, at, -1) if p.fullmatch(data, at, e)), -1)
            at = 0
            while at < len(data):
                stop = longest(whole, at, len(data))
                if stop < 0:
                    at += 1
                    continue
                if stop - (longest(head, at, stop) if head else at) >= rule.least:
                    want.append((at, k, stop))
                at = stop
        assert scan.spans(data) == sorted(want), data


def test_secret_columns_and_edges(spark):
    rows = [(1, "é token=abcdefghijkl é"), (2, None), (3, ""), (4, "a" * 100_000), (1, "é token=abcdefghijkl é"),
            (5, "token = 'ABCdef123456' 0123456789abcdef0")]
    docs = frame(spark, rows)
    got = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["found"]]
           for r in scan_secrets(docs, into="found").collect()}
    assert got[1] == [("assign", 2, 20)] and got[2] == [] and got[3] == []
    assert got[4] == [("hex", 0, 100_000)]
    assert got[5] == [("assign", 0, 21), ("hex", 23, 40)]  # the closing quote is not part of the secret
    masked = {r["doc_id"]: r["text"] for r in redact_secrets(docs).collect()}
    assert masked[1] == "é [SECRET] é" and masked[2] is None and masked[5] == "[SECRET]' [SECRET]"
    assert scan_secrets(frame(spark, []), into="found").count() == 0


def naive_quality(text):
    ws = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = {}
    for i in range(len(ws) - 2):
        grams.setdefault(tuple(ws[i:i + 3]), []).append(i)
    rep = {p for at in grams.values() if len(at) > 1 for i in at for p in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(rep))


def test_quality_counts_equal_brute_force(spark):
    rng = random.Random(1)
    texts = [None, "", " \n\t", "one", "a b", "a b c", "a b c a b c", "é x\n" * 30, "a\x0bb\x0cc\rd", "w " * 20_000,
             "😀 | # line\nline\nline"]
    texts += [" ".join(rng.choices(["a", "b", "c.", "d\n"], k=rng.randrange(120))) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)]
    got = {r["doc_id"]: r for r in judge(frame(spark, rows)).collect()}
    for i, t in rows:
        r = got[i]
        want = naive_quality(t)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want, t
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r["kept"] and r["base_failed"])
    assert judge(frame(spark, [])).count() == 0


def test_quality_rules_by_line(spark):
    good = " ".join(f"word{i}" for i in range(60)) + "."
    text = "\n".join([good, "Home | News | About | Contact | Shop | Help", "Menu", "All rights reserved by them now ok.",
                      "a### b$$$ c%%% d*** e&&&."])
    quoted = good.replace("word7 ", "word7 > word8 | ")
    r = judge(frame(spark, [(1, text), (2, good.replace(" ", " | ")), (3, quoted)])).orderBy("doc_id").collect()
    assert r[2]["kept"] and r[2]["clean_text"] == quoted  # a few separators in a closed sentence do no harm
    assert r[0]["clean_text"] == good and r[0]["kept"]
    assert not r[1]["kept"] and not r[1]["base_failed"]


def naive_rule(host, path, rules):
    fits = [(len(h) + len(p), h.count("."), h + p, v) for v, h, p in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[2:] if fits else None


def test_trie_equals_linear_search():
    rng = random.Random(3)
    labels, segments = ["a", "b", "org", "com", "x1"], ["", "en", "e", "1", "12", "en1"]
    rules = {}
    for _ in range(60):
        host = ".".join(rng.choices(labels, k=rng.randrange(1, 4)))
        path = rng.choice(["", "/" + "/".join(rng.choices(segments, k=rng.randrange(1, 3)))])
        rules[host, path] = rng.choice(["allow", "block"])
    rules = [(v, h, p) for (h, p), v in rules.items()] + [r for r in URL_RULES if (r[1], r[2]) not in rules]
    trie = build_trie(rules)
    for _ in range(3000):
        host = ".".join(rng.choices(labels, k=rng.randrange(1, 5)))
        path = rng.choice(["", "/" + "/".join(rng.choices(segments, k=rng.randrange(1, 5)))])
        got, want = find_rule(trie, host, path), naive_rule(host, path, rules)
        assert (got and (len(got[1]), got[2] if got[1] == want[0] else None)) == (want and (len(want[0]), want[1])), \
            (host, path)


def test_long_urls_take_linear_time():
    trie, begun = build_trie(URL_RULES), time.monotonic()
    assert find_rule(trie, "a.example.org", "/" + "e" * 4_000_000)[1] == "org/"
    assert find_rule(trie, "example.org", "/en/1" + "2" * 4_000_000)[1] == "example.org/en/1"
    assert find_rule(trie, "example.org", "/en" * 1_000_000)[1] == "org/"
    assert time.monotonic() - begun < 20


def test_urls_and_edges(spark):
    assert split_url("HTTP://WWW.Example.ORG/ES/x?q=/#f") == ("www.example.org", "/ES/x")
    assert split_url("https://a.com?x=/b") == ("a.com", "") and split_url("no scheme") == ("", "")
    rows = [(1, "http://m.example.org/es/1"), (2, "http://example.org/en/17"), (3, "http://a.org"), (4, None),
            (5, "http://b.com/de/"), (6, "http://b.com/fr/x"), (7, ""), (1, "http://m.example.org/es/1")]
    pages = frame(spark, rows, "page_id bigint, url string, host string, verdict string")
    got = {r["page_id"]: (r["x"]["rule"], r["x"]["verdict"]) for r in filter_urls(pages, into="x").collect()}
    assert got == {1: ("example.org/es/", "block"), 2: ("example.org/en/1", "block"), 3: (None, "allow"),
                   4: (None, "block"), 5: ("com/de/", "block"), 6: ("com/fr/", "allow"), 7: (None, "block")}
    assert filter_urls(frame(spark, [], "page_id bigint, url string"), into="x").count() == 0


def lcs_cover(template, text):
    a, b = words(template), words(text)
    best = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, best[j + 1] = best[j + 1], max(best[j + 1], best[j], last + (x == y))
    return best[-1] / len(a)


def test_license_spans(spark):
    mit = TEMPLATES["MIT"]
    changed = mit.replace("free of charge, ", "").replace("Software", "Program", 2)
    text = f"Some words first.\n{changed}\nand more é words. Licensed under CC BY-NC 4.0. end"
    rows = [(1, text), (2, None), (3, ""), (4, "licensed"), (5, "x " * 30_000 + TEMPLATES["ISC"]), (1, text),
            (6, "Released under the MIT License. " * 3)]
    got = {r["doc_id"]: r["m"] for r in scan_licenses(frame(spark, rows), into="m").collect()}
    assert [m["license"] for m in got[1]] == ["MIT", "CC-BY-NC-4.0-notice"]
    m = got[1][0]
    assert text[m["start"]:m["end"]] == changed.rstrip(".")
    assert m["coverage"] == pytest.approx(lcs_cover(mit, changed)) and m["coverage"] > 0.9
    assert text[got[1][1]["start"]:got[1][1]["end"]] == "Licensed under CC BY-NC 4.0"
    assert got[2] == got[3] == got[4] == [] and [m["license"] for m in got[5]] == ["ISC"]
    assert [m["license"] for m in got[6]] == ["MIT-notice"] * 3
    assert scan_licenses(frame(spark, []), into="m").count() == 0


def test_every_whole_template_line_is_found(spark):
    """Documents that hold a notice word for word, by plain search, are exactly those with full coverage."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    flat = {k: " ".join(words(v)) for k, v in TEMPLATES.items()}
    want = {(r["doc_id"], k) for r in docs.select("doc_id", "text").collect() for k, v in flat.items()
            if f" {v} " in f" {' '.join(words(r['text']))} "}
    got = {(r["doc_id"], r["license"]) for r in scan_licenses(docs, into="m").select("doc_id", F.explode("m").alias("x"))
           .select("doc_id", "x.*").filter("coverage = 1").collect()}
    assert got == want and want


def test_digest_columns(spark):
    r = Q.op4_secret_scan(spark, SF).filter("n_hex > 0").first()
    base = [s for s in r["spans"].split(",") if s.split(":")[0] in ("assign", "access", "hex")]
    assert r["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
