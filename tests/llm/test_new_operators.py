"""Token files, prefix trie and spelling variants against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from basketflow.llm import dac, prefix_trie, queries, spelling, token_files
from basketflow.session import scratch_path

DOCS = "doc_id long, text string"
CONVS = "conv_id long, turn long, role string, text string"


def clashing(df):
    names = ("id", "n", "key", "kind", "word", "row", "h", "size", "target", "data", "file", "part", "at", "digest", "depth",
             "s1", "p1", "start", "text_hash", "__h", "_slice", "rn")
    return df.withColumns({x: F.lit("old") for x in names})


# --- 11 token files ---------------------------------------------------------------------
@pytest.mark.parametrize("n", [0, 1, 7, 8, 511, 512, 513, 70_000])
@pytest.mark.parametrize("top", [1, 2, 300, 49408, 2 ** 32])
def test_codes_read_any_position(n, top):
    rng = np.random.default_rng(n + top)
    for ids in (rng.integers(0, top, n), (rng.pareto(0.5, n)).astype(np.int64) % top):
        code = dac.Codes.from_buffer(dac.Codes.to_bytes(ids) + b"\n")
        assert len(code) == n and (code.slice(0, n) == ids).all()
        at = rng.integers(0, max(n, 1), min(n, 300))
        assert (code.get(at) == ids[at]).all()
        for _ in range(4):
            a, b = sorted(rng.integers(0, n + 1, 2).tolist())
            assert (code.slice(a, b) == ids[a:b]).all()
        with pytest.raises(IndexError):
            code.get(np.array([n]))


def test_best_widths_are_best():
    rng = np.random.default_rng(5)
    for _ in range(20):
        lengths = np.zeros(8)
        lengths[rng.integers(0, 8, 3)] = rng.integers(1, 1000, 3)
        top = max(1, int(np.flatnonzero(lengths).max()))

        def cost(widths):
            total = a = 0
            for k, w in enumerate(widths):
                here = lengths.sum() if a == 0 else lengths[a + 1:].sum()
                total += here * (w + (dac.FLAG if k + 1 < len(widths) else 0))
                a += w
            return total

        def splits(left):
            yield [left]
            for w in range(1, left):
                yield from ([w, *rest] for rest in splits(left - w))
        got = dac.best_widths(lengths)
        assert sum(got) == top and cost(got) == pytest.approx(min(map(cost, splits(top))))


@pytest.fixture(scope="module")
def tok():
    t = Tokenizer.from_file(queries.WORD_BPE)
    t.encode_special_tokens = True
    return t


ODD = ["", "  a\n\n b", "Don't. STOP!! it's'", "ÀÉ×÷ñ. x²", "<|endoftext|> a", "\x01 \x1c\x85 z", "é ́a", "İstanbul ΣΑΣ Σ",
       "a" * 3000, "'re've 'S 's'", " \x01 \x01 .", "中文 字.。", "O'RE, 'RE. x_y_ __", "\x00a", None, "same", "same"]


def test_pieces_equal_whole_texts(tok, monkeypatch):
    enc = token_files.WordEncoder(open(queries.WORD_BPE, encoding="utf-8").read())
    assert enc.by_piece
    rng = random.Random(4)
    texts = [t or "" for t in ODD] + ["".join(rng.choice("aA b'.,1\né×Σ") for _ in range(rng.randint(0, 60))) for _ in range(300)]
    want = [tok.encode(t, add_special_tokens=False).ids for t in texts]
    for bound in (token_files.CACHE_PIECES, 50):                 # a cache that overflows changes nothing
        monkeypatch.setattr(token_files, "CACHE_PIECES", bound)
        for k in range(0, len(texts), 40):
            ids, n = enc.encode(texts[k:k + 40])
            assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == want[k:k + 40]


def test_token_files_round_trip(spark, tok):
    rows = list(enumerate(ODD)) + [(3, "again"), (3, "again"), (None, "no id"), (None, None), (-5, "minus")]
    random.Random(1).shuffle(rows)
    ids = {(d, t): tok.encode(t or "", add_special_tokens=False).ids + [2] for d, t in rows}
    df = clashing(spark.createDataFrame(rows, DOCS))
    for size in (token_files.FILE_IDS, 40):                      # many small files: the same corpus
        path = scratch_path(spark, "t-tokens") + "/files"
        token_files.write(df, path, queries.WORD_BPE, end_id=2, file_ids=size)
        docs = token_files.documents(spark, path).cache()
        got = token_files.with_start(docs).orderBy("start").collect()
        assert sorted(((r["doc_id"], bytes(r["ids_le"])) for r in got), key=repr) == sorted(
            ((d, np.array(ids[d, t], "<u4").tobytes()) for d, t in rows), key=repr)
        assert [r["doc_id"] for r in got] == sorted((r["doc_id"] for r in got), key=lambda d: (d is not None, d or 0))
        upto = 0
        for r in got:
            assert r["start"] == upto and r["n_tokens"] == len(r["ids_le"]) // 4
            upto += r["n_tokens"]
        corpus = np.frombuffer(b"".join(bytes(r["ids_le"]) for r in got), "<u4")
        asked = [0, 1, 39, 40, 41, upto - 1, upto, -1, None, 5, 5]
        at = {r["position"]: r["token"] for r in token_files.tokens_at(
            spark, path, spark.createDataFrame([(x,) for x in asked], "position long")).collect()}
        assert at == {x: int(corpus[x]) for x in asked if x is not None and 0 <= x < upto}


def test_token_files_of_nothing(spark):
    path = scratch_path(spark, "t-tokens") + "/files"
    token_files.write(spark.createDataFrame([], DOCS), path, queries.WORD_BPE)
    assert token_files.with_start(token_files.documents(spark, path)).count() == 0


# --- 12 prefix trie ---------------------------------------------------------------------
def brute_trie(rows, opening=True):
    conv = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            conv[c].append(((t is not None, t or 0), r or "", x or ""))
    seqs = {}
    for v in conv.values():
        v.sort()
    for c, v in conv.items():
        h = zlib.crc32(str(c).encode()) % 6 if opening else 0
        base = [x[1:] for x in conv.get(c - c % 100, [])]
        seqs[c] = base[:h] + [x[1:] for x in v][h:]
    mem, kids = defaultdict(list), defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            mem[tuple(s[:d])].append(c)
    for k in mem:
        if k:
            kids[k[:-1]].append(k)
    leaves, saved, out = {}, {}, set()
    for k in sorted(mem, key=len, reverse=True):
        leaves[k] = sum(leaves[x] for x in kids[k]) or 1
        saved[k] = sum(saved[x] for x in kids[k]) + ((len(mem[k]) - 1) * len(k[-1][1]) if k else 0)
    for k, m in mem.items():
        e = ",".join(str(c) for c in sorted(m) if len(seqs[c]) == len(k))
        out.add((min(m), len(k), min(mem[k[:-1]]) if k else None, len(m), len(kids[k]), leaves[k], saved[k],
                 hashlib.sha256(e.encode()).hexdigest()))
    return out


TRIE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def test_prefix_trie_against_brute_force(spark, monkeypatch):
    rng = random.Random(6)
    rows = []
    for c in list(range(0, 40)) + [100, 101, 350, 351, -7]:
        for t in range(rng.randint(1, 9)):
            rows.append((c, t, rng.choice(["user", "assistant", None]), rng.choice(["hi", "é ß", "", None, "x" * 50])))
    rows += [(200, t, "user", f"turn {t % 3}") for t in range(300)]               # one long conversation
    rows += [(c, 0, "user", "hello") for c in range(500, 700)]                    # a crowd of equal ones
    rows += [(800, None, "user", "null turn first"), (800, 1, "a", "b"), (None, 1, "user", "nobody's"), (801, None, None, None)]
    df = spark.createDataFrame(rows, CONVS)
    turns = prefix_trie.number_turns(clashing(df))
    monkeypatch.setattr(prefix_trie, "PIECE", 7)                                  # lists of ends in many pieces
    got = prefix_trie.summary(*prefix_trie.share_openings(turns)).select(TRIE).collect()
    assert len(got) == len(set(got)) and {tuple(r) for r in got} == brute_trie(rows)


def test_prefix_trie_ties_and_repeats(spark):
    rows = [(1, 5, "b", "x"), (1, 5, "a", "y"), (1, 5, "a", "y"), (2, 5, "a", "y"), (2, 5, "b", "x"), (2, 5, "a", "y")]
    turns = prefix_trie.number_turns(spark.createDataFrame(rows, CONVS))
    convs = turns.select("conv_id").distinct()
    got = prefix_trie.summary(convs, turns).collect()
    # tied turns stand in one order for every conversation, so the two are equal
    assert sorted((r["depth"], r["n_convs"], r["n_children"]) for r in got) == [(0, 2, 1), (1, 2, 1), (2, 2, 1), (3, 2, 0)]
    empty = prefix_trie.number_turns(spark.createDataFrame([], CONVS))
    assert prefix_trie.summary(*prefix_trie.share_openings(empty)).count() == 0


def test_contraction_of_any_forest(spark):
    rng = random.Random(9)
    nodes = [(0, None, 3)] + [(i, i - 1, 1) for i in range(1, 400)]                     # a chain
    nodes += [(1000 + i, 399, i) for i in range(300)]                                  # a star below it
    nodes += [(5000, None, 7)] + [(5000 + i, 5000 + rng.randrange(i), rng.randint(0, 9)) for i in range(1, 300)]
    df = spark.createDataFrame(nodes, "id long, parent long, w long").withColumn("one", F.lit(1))
    got = {r["id"]: (r["w"], r["one"]) for r in prefix_trie.subtree_totals(df, ["w", "one"]).collect()}
    want = {i: [w, 1] for i, _, w in nodes}
    for i, up, _ in sorted(nodes, reverse=True):
        if i >= 1000 and i < 5000 or up is not None:
            want[up][0] += want[i][0]
            want[up][1] += want[i][1]
    assert got == {i: tuple(v) for i, v in want.items()}
    assert prefix_trie.subtree_totals(df.limit(0), ["w", "one"]).count() == 0


def test_a_shared_prefix_name_stops_the_job(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "_limbs", lambda: {f"s{k}": F.lit(1).cast("long") for k in range(1, 5)})
    turns = prefix_trie.number_turns(spark.createDataFrame([(1, 0, "u", "a"), (2, 0, "u", "b")], CONVS))
    with pytest.raises(Exception, match="share a name"):
        prefix_trie.summary(turns.select("conv_id").distinct(), turns).count()


# --- 13 spelling ------------------------------------------------------------------------
def brute_variants(words):
    near = defaultdict(set)
    at = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            at[w[:i], w[i + 1:]].add(w)
            if w[:i] + w[i + 1:] in words:
                near[w].add(w[:i] + w[i + 1:])
                near[w[:i] + w[i + 1:]].add(w)
    for s in at.values():
        for a in s:
            near[a] |= s - {a}
    form = {}
    for w, n in words.items():
        if near[w]:
            b = min(near[w], key=lambda x: (-words[x], x))
            if words[b] >= 2 * n:
                form[w] = b
    out = set()
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n, len(near[w]), words.get(form.get(w))))
    return out


WORDS = ["word", "form", "root", "n", "n_near", "form_n"]


def test_variants_against_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(1, 6))): rng.randint(1, 60) for _ in range(900)}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert {tuple(r) for r in spelling.variants(df).select(WORDS).collect()} == brute_variants(words)
    monkeypatch.setattr(spelling, "PLAIN", 3)                                     # most keys as fingerprints
    assert {tuple(r) for r in spelling.variants(df).select(WORDS).collect()} == brute_variants(words)
    assert spelling.variants(df.limit(0)).count() == 0


def test_variants_of_long_words(spark):
    rng = random.Random(5)
    words = {}
    for base in ("a" * 70, "ab" * 33, "x" * 64, "y" * 63, "z" * 65, "é" * 20 + "b" * 45):
        for _ in range(30):
            s = list(base)
            for _ in range(rng.randint(0, 2)):
                op, k = rng.choice("ird"), rng.randrange(len(s))
                s[k:k + (op != "i")] = [] if op == "d" else [rng.choice("abxé")]
            words["".join(s)] = rng.randint(1, 40)
    words |= {"q" * 5000: 9, "q" * 4999 + "r": 3, "q" * 4999: 1}
    got = spelling.variants(spark.createDataFrame(list(words.items()), "word string, n long")).select(WORDS).collect()
    assert {tuple(r) for r in got} == brute_variants(words)


def test_words_are_counted_as_the_rule_says(spark, monkeypatch):
    rng = random.Random(8)
    vocabulary = ["Straße", "strasse", "house", "House", "HOUSE", "hous", "Éclair×", "naïve", "a", "tiny", "letters", "lettres"]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(40)) + "1x-y") for i in range(120)]
    rows += [(None, "house house"), (7, None), (8, ""), (9, "house"), (9, "house"), (10, "z" * 300 + " " + "z" * 300)]
    want = Counter()
    for d, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{d}:{w}".encode())
            want[w[:h % len(w)] + w[h % len(w) + 1:] if d is not None and h % 97 == 0 else w] += 1
    want = {w: n for w, n in want.items() if len(w) >= 5 and n >= 3}
    df = clashing(spark.createDataFrame(rows, DOCS))
    for held in (spelling.HELD, 3):
        monkeypatch.setattr(spelling, "HELD", held)
        assert {r["word"]: r["n"] for r in spelling.count_words(df, drop_every=97).collect()} == want
    assert spelling.count_words(spark.createDataFrame([], DOCS)).count() == 0


def test_op11_equals_the_library(spark, sf, tok):
    got = {r["doc_id"]: r for r in queries.op11_token_ids(spark, sf).collect()}
    upto = 0
    for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect():
        ids = np.array(tok.encode(r["text"] or "", add_special_tokens=False).ids + [2], "<u4")
        assert (got[r["doc_id"]]["start"], got[r["doc_id"]]["n_tokens"]) == (upto, len(ids))
        assert got[r["doc_id"]]["ids_crc32"] == zlib.crc32(ids.tobytes())
        upto += len(ids)
