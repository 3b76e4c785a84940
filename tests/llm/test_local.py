"""Operators' task-side code against brute force, without Spark."""

import random
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from basketflow.llm import bpe, html_cut, licenses, mixing, pivots, pretokens, simhash, toxicity, url_rules
from basketflow.llm.components import Forest

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def reference_encoding():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.parse_ranks(RANKS),
                             special_tokens={})


def encode_all(texts):
    enc = bpe.encoder(RANKS)
    raw = [t.encode() for t in texts]
    ids, n = enc.encode(b"".join(raw), np.concatenate(([0], np.cumsum([len(r) for r in raw]))))
    upto = np.concatenate(([0], np.cumsum(n)))
    return [ids[a:b].tolist() for a, b in zip(upto[:-1], upto[1:], strict=True)]


PIECES = ["a", "S", "s", "t", "re", "ve", "ll", "'", "'s", "'re", " ", "  ", "\n", "\t", " ", "　", "1", "½", "é", "汉",
          "😀", "!", "‍", "\x1c", "\x00"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=30).map("".join), min_size=1, max_size=6))
def test_bpe_equals_reference_library(texts):
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.encoder(RANKS).v.ranks,
                            special_tokens={})
    got = encode_all(texts)
    assert got == [enc.encode_ordinary(t) for t in texts]
    assert [bpe.encoder(RANKS).decode(np.array(g, np.int64)).tobytes().decode() for g in got] == texts


def test_bpe_every_code_point(reference_encoding):
    cps = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    random.Random(1).shuffle(cps)
    texts = ["".join(cps[i:i + 64]) for i in range(0, len(cps), 64)]
    assert encode_all(texts) == [reference_encoding.encode_ordinary(t) for t in texts]


def test_bpe_long_pieces_windows_and_stray_bytes(reference_encoding):
    texts = ["ab" * 20000, "x" * 500 + " " * 3000 + "y", "\n" * 2000]
    assert encode_all(texts) == [reference_encoding.encode_ordinary(t) for t in texts]
    long = ("word 'll " * 40 + "\n") * 20000
    cuts = bpe._windows(long.encode())
    assert len(cuts) > 2
    parts = [p for a, b in zip(cuts[:-1], cuts[1:], strict=True) for p in encode_all([long.encode()[a:b].decode()])[0]]
    assert parts == reference_encoding.encode_ordinary(long)
    enc = bpe.encoder(RANKS)
    ids, _ = enc.encode(b"ab\xff\xc3 c", np.array([0, 6]))
    assert enc.decode(ids).tobytes() == b"ab\xff\xc3 c"


def test_scan_is_the_running_composition():
    rng = np.random.default_rng(3)
    code, _, apply, _ = pretokens.monoid()
    syms = rng.integers(0, 14, 5000)
    state, want = 0, []
    for s in syms:
        want.append(state)
        state = int(apply[int(code[s]) * 8 + state])
    scan = pretokens.exclusive_scan(code[syms], block=16)
    assert apply[scan.astype(int) * 8].tolist() == want


# --- simhash ----------------------------------------------------------------------
def slow_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    sh = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="abÄé \n\t ", max_size=60))
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) == slow_fingerprint(text)


def groups(n, pairs):
    lab = list(range(n))
    for i, j in pairs:
        a, b = lab[i], lab[j]
        lab = [min(a, b) if x in (a, b) else x for x in lab]
    return lab


@pytest.mark.parametrize("split", [False, True])
def test_tile_links_span_all_near_pairs(split):
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**64, 40, dtype=np.uint64)
    fps = np.unique(np.concatenate([base] + [base ^ np.uint64(1 << int(b)) for b in rng.integers(0, 63, 12)]))
    rng.shuffle(fps)
    half = len(fps) // 2
    a, b = simhash._tile(fps[:half], fps[half:], 4) if split else simhash._tile(fps, None, 4)
    where = {int(f): i for i, f in enumerate(fps)}
    got = groups(len(fps), [(where[int(x)], where[int(y)]) for x, y in zip(a, b, strict=True)])
    near = [(i, j) for i in range(len(fps)) for j in range(i) if bin(int(fps[i] ^ fps[j])).count("1") <= 4
            and (not split or (i < half) != (j < half))]
    assert got == groups(len(fps), near)


def test_forest():
    f = Forest(6)
    f.add(np.array([5, 4, 1]), np.array([4, 3, 2]))
    assert f.label.tolist() == [0, 1, 1, 3, 3, 3]


# --- pivots ------------------------------------------------------------------------
def test_farthest_first_spreads():
    x = np.array([[1, 0], [0.999, 0.0447], [-1, 0], [0, 1.0]])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    assert {tuple(np.round(r, 2)) for r in pivots.farthest_first(x, 3)} == {(1, 0), (-1, 0), (0, 1)}
    assert len(pivots.farthest_first(np.ones((5, 2)) / np.sqrt(2), 3)) == 1
    assert len(pivots.pivots_of({}, 7)) == pivots.PIVOTS


# --- mixing ------------------------------------------------------------------------
def test_targets_share_cap_and_reshare():
    t = mixing.targets({"a": 100, "b": 1, None: 50})
    assert t["b"] == 3 and abs(sum(t.values()) - 151) < 1e-9
    assert abs(t["a"] * 3 - t[None]) < 1e-9
    assert mixing.targets({}) == {} and mixing.targets({"a": 0}) == {"a": 0}


def test_min_cost_flow_prefers_first_uses():
    # two sources share a pattern: it is used once for both quotas before anything is repeated
    assert mixing.min_cost_flow([10, 5, 7], [{0}, {0, 1}, {1}], [12, 10]) == [10, 5, 7]
    assert mixing.min_cost_flow([10], [{0}], [25]) == [25]
    assert mixing.min_cost_flow([10], [{0}], [99]) == [30]
    assert mixing.min_cost_flow([0, 4], [{0}, {0}], [6]) == [0, 6]


def test_route_solves_connected_sources_together():
    rng = random.Random(13)
    for _ in range(40):
        size = [rng.randint(0, 9) for _ in range(6)]
        member = [set(rng.sample(range(4), rng.randint(1, 2))) for _ in size]
        quota = [rng.randint(0, 20) for _ in range(4)]
        a, b = mixing.route(size, member, quota), mixing.min_cost_flow(size, member, quota)
        cost = lambda f: sum(k * (k + 1) // 2 * max(0, min(x - k * s, s)) for x, s in zip(f, size, strict=True)
                             for k in range(3))
        assert sum(a) == sum(b) and cost(a) == cost(b)
    many = mixing.route([7] * 200_000, [{i} for i in range(200_000)], [i % 30 for i in range(200_000)])
    assert many == [min(21, i % 30) for i in range(200_000)]
    assert many[:30] == [mixing.min_cost_flow([7], [{0}], [q])[0] for q in range(30)]
    many = mixing.route([7] * 3000, [{i} for i in range(3000)], [10] * 3000)
    assert many == [10] * 3000


# --- html --------------------------------------------------------------------------
def test_extract():
    page = ("<html><head><title>T</title><style>p{}</style><script>var t='</p>';</script></head><body><nav><ul><li>"
            "<a href=x>Menu</a></ul></nav><!-- c --><div class=ad>Buy now and save</div><article><h1>Head &amp; line</h1>"
            "<p><b>One\n two.<br><p>Three&nbsp;four &am</article><div id=comments><p>Nice post, a comment of some length"
            "</p></div><footer>&copy; x")
    assert html_cut.extract(page) == "Head & line\n\nOne two.\n\nThree four &am"
    assert html_cut.extract(None) == html_cut.extract("") == html_cut.extract("<p>") == ""
    assert html_cut.extract("just text") == "just text"
    deep = "<div>" * 3000 + "text" + "</div>" * 3000
    assert html_cut.extract(deep) == "text"


LONG = "A paragraph of the article with quite some words in it. " * 6


@pytest.mark.parametrize("before,after", [
    ('<body class="single has-sidebar">', ""), ('<html class="no-cookie"><body id=page-with-comments>', ""),
    ('<article class="post has-comments">', "</article>"), ('<article class="has-comments">', "</article>"),
    ('<body><main class="sidebar-right"><article class=post>', "</article></main>"),
    ('<div class="wrap has-sidebar"><article>', "</article></div>"),
    ('<div class="wrap has-sidebar"><div class="entry-content">', "</div></div>"),
    ('<div class="layout sidebar-left"><h1>H</h1>', "</div>"),
    ('<div style="overflow:hidden">', "</div>"), ('<div title="The hidden valley">', "</div>"),
    ('<div aria-hidden="false">', "</div>"), ('<div data-id="sidebar" data-class=menu data-role="popup">', "</div>"),
    ('<body><article class="comment-free"><div>', "</div></article>"),
])
def test_layout_words_do_not_drop_the_article(before, after):
    text = LONG.strip()
    page = f"<html>{before}<p>{text}</p><p>{text}</p>{after}" \
           f"<div id=comments><article class='comment'><p>Nice post, {text}</p></article></div>"
    got = html_cut.extract(page).split("\n\n")
    assert [x for x in got if x != "H"] == [text, text]


@pytest.mark.parametrize("tag", [
    "<div hidden>", "<div HIDDEN>", '<div hidden="">', "<div aria-hidden=true>", '<div aria-hidden="true">',
    '<div class="sidebar">', "<div id='comments-list'>", "<div role=navigation>"])
def test_boilerplate_beside_the_article_is_dropped(tag):
    text = LONG.strip()
    posts = f'<div class="blog has-sidebar">{2 * f"<article class='post has-comments'><p>{text}</p></article>"}</div>'
    assert html_cut.extract(f"<body>{posts}{tag}<p>Of no use. {text}</p></div>") == f"{text}\n\n{text}"
    assert html_cut.extract(f"<body><article><p>{text}</p></article>{tag}<p>Of no use. {text}</p></div>") == text


@pytest.mark.parametrize("page,want", [
    ('<article><p>one</p><img alt="5" tall"><p>two</p><p>three</p></article>', ["one", "two", "three"]),
    ("<a href=/x'><p>two</p><p>it's three</p>", ["two", "it's three"]),
    ("<p><img alt=it's>one<p>it's two", ["one", "it's two"]),
    ('<p class="x>one</p><p>two</p>', ["one", "two"]), ("<p class='x y=z>one", ["one"]),
    ('<p title = "a > b">one</p>', ["one"]), ("<p title='a > b' id=c>one</p><p>two", ["one", "two"]),
    ('<p title="a>b"id="c>d"/>one', ["one"]), ('<p title=>one</p><p ="x>two', ["one", "two"]),
    ('<p x"y=1 z>one</p "><p>two', ["one", "two"]), ('<p title="a', []), ("<p =", []),
])
def test_stray_quotes_lose_no_text(page, want):
    assert [b.text for b in html_cut.blocks(page)] == want


def test_min_cut_equals_enumeration():
    rng = random.Random(5)
    for _ in range(60):
        n = rng.randint(1, 6)
        c, b = [rng.randint(0, 9) for _ in range(n)], [rng.randint(0, 9) for _ in range(n)]
        edges = [(i, j, rng.randint(0, 5)) for i in range(n) for j in range(i) if rng.random() < 0.5]

        def cost(lab, c=c, b=b, edges=edges, n=n):
            return sum(b[i] if lab[i] else c[i] for i in range(n)) + sum(w for i, j, w in edges if lab[i] != lab[j])
        best = min(cost([k >> i & 1 for i in range(n)]) for k in range(1 << n))
        assert cost(html_cut.min_cut(c, b, edges)) == best


# --- url rules ---------------------------------------------------------------------
@pytest.mark.parametrize("url,want", [
    (None, ("", "", None, "allow")), ("no scheme", ("", "", None, "allow")), ("", ("", "", None, "allow")),
    ("https://A.Example.ORG/es/1?x#y", ("a.example.org", "/es/1", "example.org/es/", "block")),
    ("http://example.org/en/19", ("example.org", "/en/19", "example.org/en/1", "block")),
    ("http://example.org/en/2", ("example.org", "/en/2", "org/", "allow")),
    ("http://myexample.org/es/", ("myexample.org", "/es/", "org/", "allow")),
    ("http://x.org", ("x.org", "", None, "allow")), ("http://x.com/FR/", ("x.com", "/FR/", None, "allow")),
    ("http://x.com/fr/a", ("x.com", "/fr/a", "com/fr/", "allow")),
    ("http://free-bets.example.com/en/", ("free-bets.example.com", "/en/", None, "block")),
    ("http://alphabets.example.net/", ("alphabets.example.net", "/", None, "allow")),
    ("http://free-bets.example.org/fr/", ("free-bets.example.org", "/fr/", "org/", "allow")),
])
def test_judge(url, want):
    for counts in ({}, {"example": 9, "org": 1, "com": 5}):
        assert url_rules.Judge(url_rules.build_index(url_rules.rules(), counts)).judge(url) == want


# --- licenses ----------------------------------------------------------------------
def test_increasing_is_longest():
    rng = random.Random(6)
    for _ in range(100):
        v = [rng.randint(0, 9) for _ in range(rng.randint(0, 9))]
        best = max((bin(m).count("1") for m in range(1 << len(v))
                    if (s := [x for i, x in enumerate(v) if m >> i & 1]) == sorted(set(s))), default=0)
        got = [v[i] for i in increasing_checked(v)]
        assert len(got) == best and got == sorted(set(got))


def increasing_checked(v):
    return licenses.increasing(v)


@pytest.mark.parametrize("line,want", [
    ("Released under the BSD License.", "BSD-line"), ("Released under the Artistic License.", None),
    ("Released under the MIT Press License.", None), ("Released under the MIT Licence.", "MIT-line"),
    ("Licensed under CC BY-ND 4.0", "CC-BY-ND-4.0-line"), ("Licensed under CC BY-NC-SA 4.0", "CC-BY-NC-SA-4.0-line"),
    ("Licensed under CC BY-NC 4.0", "CC-BY-NC-4.0-line"), ("Licensed under CC BY 4.0", "CC-BY-4.0-line"),
    ("Licensed under CC BY-SA 4.0", "CC-BY-SA-4.0-line"), ("Licensed under CC BY-SA 3.0", None),
    ("This work is licensed under the GNU Lesser General Public License, version 3", "LGPL-3.0-line"),
    ("This work is licensed under the GNU Affero General Public License, version 3", "AGPL-3.0-line"),
    ("This work is licensed under the GNU Free General Public License, version 3", None),
    ("This work is licensed under the GNU General Public License, version 1", None),
    ("This work is licensed under the GNU General Public License, version 2", "GPL-2.0-line"),
    ("This work is licensed under the GNU General Public License v3", "GPL-3.0-line"),
    ("Licensed under the Apache License, Version 2.0", "Apache-2.0-line"),
    ("Licensed under the Apache License 2.0", "Apache-2.0-line"),
    ("Licensed under the Academic License, Version 2.0", None), ("Licensed under the Apache License, Version 1.1", None),
])
def test_license_lines_of_other_licenses(line, want):
    for text in (line, f"Some words before it. {line} And some words after it."):
        assert [g[0] for g in licenses.scan(text, licenses.load_templates())] == ([want] if want else [])


def test_whole_licenses_are_told_apart():
    templates = licenses.load_templates()
    seen = set()
    for t in templates:
        if t.name not in seen:
            seen.add(t.name)
            text = " ".join(["Foo bar baz."] * 40 + t.words + ["Foo bar baz."] * 40)
            assert [g[:2] for g in licenses.scan(text, templates)] == [(t.name, 1.0)]
    assert {"ISC-text", "BSD-2-Clause-text", "LGPL", "AGPL", "GPL-3.0-text", "Unlicense-text"} <= seen


def test_only_matches_inside_longer_ones_are_dropped():
    own = licenses.load_templates({"left": "a b c d e f g h i j k", "right": "j k l m n o p q r", "inner": "c d e f g"})
    got = licenses.scan("a b c d e f g h i j k l m n o p q r", own)
    assert [(g[0], *g[3:]) for g in got] == [("left", 0, 10), ("right", 9, 17)]


def test_license_scan_finds_edited_and_repeated_texts():
    t = licenses.load_templates()
    mit = licenses.TEMPLATES["MIT"]
    text = "foo " * 50 + mit.replace("hereby ", "").upper() + " bar " * 30 + mit + "\n" + \
        licenses.TEMPLATES["CC-BY-NC-4.0-line"]
    got = licenses.scan(text, t)
    assert [g[0] for g in got] == ["MIT", "MIT", "CC-BY-NC-4.0-line"]
    assert got[0][1] < 1 == got[1][1]
    assert licenses.scan(None, t) == licenses.scan("", t) == licenses.scan("license of software " * 200, t) == []


# --- toxicity ----------------------------------------------------------------------
def test_grammar_weighs_clauses():
    m = toxicity.Model({"idiot$": 4.0, "scu": 3.0}, [-2.0, 2.0, 1.0, 2.0])
    plain = m.features("What an idiot that is.")
    aimed = m.features("You idiot.")
    negated = m.features("He is not an idiot.")
    quoted = m.features("Somebody said idiot once.")
    assert aimed[0] > plain[0] > quoted[0] > negated[0] > 0
    assert m.features("SCUMMY!! scum") [1] == 2
    assert m.features("idiots") == m.features(None) == m.features("") == (0.0, 0.0, 0.0)
    assert m.features("I will kill you.")[2] > 0 == m.features("They kill time.")[0]
    s = m.score(np.array([plain, (0, 0, 0)]))
    assert s[0] > 0.5 > s[1]


def test_bpe_chunks_are_small():
    """A worker holds the arrays of one chunk at a time: many times the chunk's bytes."""
    import pyarrow as pa
    from basketflow.llm import bpe
    texts = pa.array(["word " * 2000] * 300 + [None])
    parts = list(bpe._text_chunks(texts))
    assert sum(n for _, n, _, _ in parts) == 301 and b"".join(d for _, _, d, _ in parts) == b"word " * 600_000
    assert max(len(d) for _, _, d, _ in parts) <= 1 << 19
