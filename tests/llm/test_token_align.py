"""Token alignment against a quadratic version that compares every pair of tokens."""
import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from plantlake.llm import queries as Q
from plantlake.llm import token_align
from plantlake.llm.token_align import Block, Tokenizers, align, tokenizers

SF = "/root/testdata/sf0.001"
COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")


@pytest.fixture(scope="module")
def pair():
    return tokenizers(Tokenizers())


@pytest.fixture(scope="module")
def libraries():
    """Both tokenizers by their own libraries, with token bytes read from the vocabularies."""
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(Tokenizers().a)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=Tokenizers().b)
    decode = {}
    for i in range(b.get_piece_size()):
        piece = b.id_to_piece(i)
        decode[i] = bytes([int(piece[1:-1], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()
    return a, b, decode


def spans(lengths):
    at, out = 0, []
    for n in lengths:
        out.append((at, at + n))
        at += n
    return out


def naive(texts, libraries, len_a):
    """Rows of COLUMNS of all texts, by comparing all token spans of a text."""
    a_lib, b_lib, b_bytes = libraries
    rows, counts = [], Counter()
    for text in texts:
        if not text:
            rows.append(None)
            continue
        a = a_lib.encode(" " + text, add_special_tokens=False).ids
        b = b_lib.encode(text)
        if b"".join(b_bytes[i] for i in b) != (" " + text).encode():
            rows.append(None)
            continue
        sa, sb = spans([len_a[i] for i in a]), spans([len(b_bytes[i]) for i in b])
        assert sa[-1][1] == len((" " + text).encode())
        links = [(a[i], b[j]) for i, (s, e) in enumerate(sa) for j, (t, f) in enumerate(sb) if s < f and t < e]
        counts.update(links)
        groups, at = [], 0
        for end in sorted({e for _, e in sa} & {e for _, e in sb}):
            groups.append(",".join(str(x) for x, (s, e) in zip(a, sa) if at <= s and e <= end) + "|"
                          + ",".join(str(x) for x, (s, e) in zip(b, sb) if at <= s and e <= end))
            at = end
        rows.append((len(a), len(b), len(groups), links, ";".join(groups)))
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return [(0, 0, 0, 0, 0, 0, None) if r is None else
            (*r[:3], len(r[3]), sum(counts[x] == best[x[1]] for x in r[3]), sum(counts[x] for x in r[3]), r[4])
            for r in rows]


TEXTS = ["the quick brown fox", "the quick brown fox", "", None, " ", "  two  blanks\n\n\ttabs ", "naïve café 日本語 🙂🙂",
         "<|endoftext|> and </s> <s> are text", "antidisestablishmentarianism" * 9, "a" * 3000, " " * 700 + "x",
         "lower one eighth block ▁ is changed", "1234567890 " * 40, "x y z\x00w", "Ωμέγα и кириллица", "don't I'LL we've"]


def test_alignment_equals_all_pairs(spark, pair, libraries):
    rng = random.Random(5)
    texts = TEXTS + ["".join(rng.choice(["the ", "ing", "é", " ", "\n", "zq", "日", ".", "’s "]) for _ in range(40))
                     for _ in range(60)]
    ids = [None if i == 1 else i // 2 for i in range(len(texts))]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in zip(ids, texts)],
                                 "doc_id bigint, text string, groups string, block int").repartition(3)
    got = align(docs).select("doc_id", *COLUMNS).collect()
    expected = naive(texts, libraries, pair.len_a.tolist())
    assert Counter(map(tuple, got)) == Counter((i, *r) for i, r in zip(ids, expected))
    assert expected[11] == (0, 0, 0, 0, 0, 0, None)  # U+2581 comes back as a blank
    empty = align(docs.limit(0))
    assert empty.count() == 0 and empty.columns == ["doc_id", *COLUMNS]
    none = align(docs.filter("text is null"), id_col="doc_id").collect()
    assert [tuple(r)[1:] for r in none] == [(0, 0, 0, 0, 0, 0, None)]


def test_query_equals_all_pairs(spark, pair, libraries):
    docs = [r for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if len(r["text"] or "") < 4000]
    table = spark.createDataFrame([(str(r["doc_id"]), r["text"]) for r in docs], "key string, body string")
    got = {r["key"]: tuple(r)[1:] for r in align(table, id_col="key", text_col="body").collect()}
    expected = naive([r["text"] for r in docs], libraries, pair.len_a.tolist())
    assert got == {str(r["doc_id"]): e for r, e in zip(docs, expected)}
    whole = {r["doc_id"]: r for r in Q.op13_token_align(spark, SF).collect()}
    for r, e in zip(docs, expected):  # counts need the whole corpus; the rest does not
        w = whole[r["doc_id"]]
        assert (w["n_a"], w["n_b"], w["n_groups"], w["n_links"]) == e[:4]
        assert w["groups_sha256"] == (hashlib.sha256(e[6].encode()).hexdigest() if e[6] else "")


def test_blocks_and_forgetting_change_nothing(spark, monkeypatch, pair):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60).select("doc_id", "text").repartition(1)
    rows = docs.collect()
    small, large = Block(pair), Block(pair)
    monkeypatch.setattr(token_align, "MEMO", 50)
    for i, r in enumerate(rows):
        a, b = pair.encode(r["text"])
        small.add(a, b)
        small.align_new()
        large.add(a, b)
        one = small.groups(0), small.pairs()[0]
        small.clear()
        large.align_new()
        assert (large.groups(i), [large.pairs()[0][i]]) == one
    assert len(small.text) <= 50 + 30_000


def test_a_known_word_is_tokenised_once(monkeypatch, pair):
    rng = random.Random(7)
    texts = [t for t in TEXTS if t] + ["".join(rng.choice(["the ", "ing", "é", " ", "\n ", "zq", "日", ".", "\u00a0 "])
                                               for _ in range(60)) for _ in range(80)]
    asked = []
    whole = type(pair).encode
    monkeypatch.setattr(type(pair), "encode", lambda self, text: asked.append(text) or whole(self, text))
    block = Block(pair)
    for text in ("one two two  three", "two one four"):
        block.add_text(text)
    assert asked == ["one two two  three", "four"]
    block.add_text("one ▁ five")  # not restored
    block.add_text("five two")
    block.align_new()
    assert [block.groups(i)[0] > 0 for i in range(4)] == [True, True, False, True]
    monkeypatch.setattr(token_align, "MEMO", 50)
    small, ids = Block(pair), Block(pair)  # windows cut from texts, and from ids
    for text in texts:
        small.add_text(text)
        ids.add(*whole(pair, text))
        small.align_new()
        ids.align_new()
        assert (small.groups(0), small.pairs()[0]) == (ids.groups(0), ids.pairs()[0])
        small.clear()
        ids.clear()
    monkeypatch.setattr(pair, "across", True)
    assert asked.clear() is None
    small.add_text("two two")
    small.add_text("two two")
    assert asked == ["two two"] * 2


def test_long_texts_are_tokenised_in_pieces(monkeypatch, pair):
    text = " ".join(f"Wörter-{i} and, it's  two\n" for i in range(400))
    whole = pair.encode(text)
    monkeypatch.setattr(token_align, "PIECE_CHARS", 37)
    cut = pair.encode(text)
    assert all(np.array_equal(x, y) for x, y in zip(whole, cut)) and len(whole[0]) > 1000


def test_fast_path_equals_the_tokenizer(pair):
    rng = random.Random(11)
    letters = [chr(c) for c in range(0, 0x250)] + list("‐‑–—’“”•…€") + [" ", " ", "\n", "a", "e", "1"] * 20
    assert pair.a.fast is not None
    for _ in range(400):
        text = " " + "".join(rng.choice(letters) for _ in range(rng.randrange(1, 120)))
        assert pair.a.fast.encode_ordinary(text) == pair.a.own.encode(text, add_special_tokens=False).ids
