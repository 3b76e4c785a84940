import math
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from basketflow.functions import text as T
from basketflow.operators import text as X


def dp_lcs(a, b):
    prev = [0] * (len(b) + 1)
    for ch in a:
        cur = [0]
        for j, cb in enumerate(b, start=1):
            cur.append(prev[j - 1] + 1 if ch == cb else max(prev[j], cur[j - 1]))
        prev = cur
    return prev[-1]


def test_lcs_reference_pair():
    assert T.lcs_length("BDCABA", "ABCBDAB") == 4
    assert abs(T.lcs_similarity("BDCABA", "ABCBDAB") - 4 / 6.5) < 1e-12
    assert T.lcs_similarity("", "") is None


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abcd", max_size=40), st.text(alphabet="abcd", max_size=40))
def test_lcs_bitparallel_matches_dp(a, b):
    assert T.lcs_length(a, b) == dp_lcs(a, b) == T.lcs_length(b, a)
    assert T.lcs_length(a, b) <= min(len(a), len(b))


def test_lcs_native_expression(spark):
    rnd = random.Random(7)
    pairs = [("BDCABA", "ABCBDAB"), ("", "abc"), ("abc", "")]
    pairs += [("".join(rnd.choice("xyz") for _ in range(rnd.randint(1, 12))),
               "".join(rnd.choice("xyz") for _ in range(rnd.randint(1, 12)))) for _ in range(30)]
    df = spark.createDataFrame(pairs, "a string, b string")
    got = [r[0] for r in df.select(T.lcs_length_expr(F.col("a"), F.col("b"))).collect()]
    assert got == [dp_lcs(a, b) for a, b in pairs]


def test_lcs_pairs_whole_texts(spark, sf):
    conv = spark.read.parquet(f"{sf}/conversations.parquet")
    got = X.lcs_pairs(conv.select("conv_id", "turn", "text")).collect()
    texts = {(r.conv_id, r.turn): r.text for r in conv.collect()}
    assert got
    for r in got[:40]:
        a, b = texts[(r.conv_id, r.turn)], texts[(r.conv_id, r.turn + 1)]
        assert r.lcs == dp_lcs(a, b)


def test_tokens_drop_empty(spark):
    df = spark.createDataFrame([("a  b ",), (" x\ty\n",)], "t string")
    assert [r[0] for r in df.select(T.tokens(F.col("t"))).collect()] == [["a", "b"], ["x", "y"]]


def test_label_stripped(spark):
    df = spark.createDataFrame([(1, "w1 w2 w1##@@##en")], "doc_id long, sentence string")
    tf = {r.word: r.tf for r in X.term_freq(df).collect()}
    assert tf == {"w1": 2, "w2": 1}


def test_inner_terms(spark):
    df = spark.createDataFrame([("abcd",)], "t string")
    got = df.select(T.inner_terms(F.col("t"))).first()[0]
    assert got == ["ab", "bc", "cd", "abc", "bcd"]


def test_segment(spark):
    df = spark.createDataFrame([("Ab, c d-éf 12",)], "t string")
    assert X.segment(df, "t").first().seg == "Ab/éf/12"


def test_pluggable_segmenter(spark):
    import pandas as pd
    from pyspark.sql.types import ArrayType, StringType

    @F.pandas_udf(ArrayType(StringType()))
    def split_on_dash(s: pd.Series) -> pd.Series:
        return s.str.split("-")

    df = spark.createDataFrame([("ab-c-def",)], "t string")
    assert X.segment(df, "t", segmenter=split_on_dash).first().seg == "ab/def"
    assert X.segment(df, "t").first().seg == "ab/def"


def test_lattice_segmentation_against_a_plain_programme(spark):
    import math
    import random
    from collections import Counter

    from basketflow.operators import lattice

    rng = random.Random(6)
    parts = ["ab", "abc", "cde", "de", "éß", "xyz", "yz", "qqqqqq", "cd"]
    corpus = [rng.choice(parts) for _ in range(200)] + ["".join(rng.choice(parts) for _ in range(rng.randint(2, 5))) for _ in range(80)]
    corpus += ["w", "zzzzzzz", "v" * 400, "aa"]
    df = spark.createDataFrame([(" ".join(corpus[i::7]),) for i in range(7)] + [(None,), ("",)], "text string")
    counts = Counter(w for w in corpus if len(w) >= 2)
    words = {w: n for w, n in counts.items() if len(w) <= 6 and n >= 2}
    total = sum(words.values())
    cost = {w: math.floor(math.log(total / n) * 1000 + 0.5) for w, n in words.items()}
    single = math.floor(math.log(total) * 1000 + 0.5) + 1000

    def plain(tok):
        best = [(0, 0, 0)]
        for j in range(1, len(tok) + 1):
            best.append(min((best[i][0] + (single if j - i == 1 else cost[tok[i:j]]), best[i][1] + 1, i)
                            for i in range(max(0, j - 6), j) if j - i == 1 or tok[i:j] in cost))
        out, j = [], len(tok)
        while j:
            out.insert(0, tok[best[j][2]:j])
            j = best[j][2]
        return "/".join(out), best[-1][1], best[-1][0]

    tokens = lattice.token_counts(df, "text")
    terms, one = lattice.dictionary(tokens)
    assert one == single
    got = {r["tok"]: (r["seg"], r["pieces"], r["cost"]) for r in lattice.segment(tokens.select("tok"), terms, one).collect()}
    assert got == {w: plain(w) for w in counts}
    inner = {(r["tok"], r["term"]) for r in lattice.index_terms(tokens.select("tok"), terms).collect()}
    assert inner == {(w, w[i:j]) for w in counts for i in range(len(w)) for j in range(i + 2, min(i + 6, len(w)) + 1)
                     if w[i:j] in words and w[i:j] != w}
    none = lattice.token_counts(df.limit(0), "text")
    terms, one = lattice.dictionary(none)
    assert lattice.segment(none.select("tok"), terms, one).count() == 0


def test_terms_of_unique_ids_are_counted_where_the_texts_arrive(spark):
    """No row per token is shuffled; repeated and missing ids are summed all the same."""
    from basketflow.operators import text as X
    one = spark.createDataFrame([(1, "a b a##@@##x"), (2, "b##@@##x"), (None, "a##@@##x")], "doc_id long, sentence string")
    tf = X.term_freq(one)
    plan = tf._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan[:plan.index("Generate explode")]
    assert {(r.doc_id, r.word): r.tf for r in tf.collect()} == {(1, "a"): 2, (1, "b"): 1, (2, "b"): 1, (None, "a"): 1}
    two = X.term_freq(one.unionByName(one))
    assert {(r.doc_id, r.word): r.tf for r in two.collect()} == {(1, "a"): 4, (1, "b"): 2, (2, "b"): 2, (None, "a"): 2}


def test_index_terms_multiply_only_where_their_document_is_summed(spark):
    from basketflow.operators import text as X
    df = spark.createDataFrame([(1, "abcd abcd ab bc"), (2, "bcd"), (None, "abc"), (3, None)], "id long, t string")
    out = X.segment_index_terms(df, "t", "id")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan[:plan.index("Generate inline")]
    # bcd is no inner term of itself; abc and bcd are words of the corpus inside abcd
    assert {(r.id, r.term): r.n for r in out.collect()} == {
        (1, "ab"): 2, (1, "bc"): 2, (1, "abc"): 2, (1, "bcd"): 2, (2, "bc"): 1, (None, "ab"): 1, (None, "bc"): 1}


def test_texts_are_counted_where_they_are(spark):
    rnd = random.Random(11)
    texts = [(i, " ".join(rnd.choice("a b bb c ä".split()) for _ in range(rnd.randint(0, 30))) or rnd.choice(["", " ", None])) for i in range(40)]
    df = spark.createDataFrame([(i, t and f"{t}##@@##en") for i, t in texts], "doc_id long, sentence string")
    counted = X.term_freq(df)
    assert "Exchange" not in counted._jdf.queryExecution().executedPlan().toString()
    want = {(i, w): t.split().count(w) for i, t in texts if t for w in t.split()}
    assert {(r.doc_id, r.word): r.tf for r in counted.collect()} == want and counted.count() == len(want)
    twice = {(r.doc_id, r.word): r.tf for r in X.term_freq(df.unionAll(df)).collect()}
    assert twice == {k: 2 * n for k, n in want.items()}


def test_smoothed_weights_by_hash_table_and_by_sort(spark, monkeypatch):
    texts = {1: "a a b", 2: "a c", 3: "a b b b"}
    df = spark.createDataFrame([(i, f"{t}##@@##en") for i, t in texts.items()], "doc_id long, sentence string")
    n_with = {w: sum(w in t.split() for t in texts.values()) for w in "abc"}
    want = {(i, w): (t.split().count(w), n_with[w], round(t.split().count(w) * math.log(4 / (n_with[w] + 1)), 9) if n_with[w] > 1 else 0.0)
            for i, t in texts.items() for w in set(t.split())}
    for words, join in ((X.HELD_WORDS, "ShuffledHashJoin"), (0, "SortMergeJoin")):
        monkeypatch.setattr(X, "HELD_WORDS", words)
        out = X.tfidf_smoothed(df)
        assert join in out._jdf.queryExecution().executedPlan().toString()
        assert {(r.doc_id, r.word): (r.tf, r.df, r.weight) for r in out.collect()} == want


def test_sentence_tokens_of_texts_without_a_token(spark, tmp_path):
    import duckdb

    from basketflow.plans import q_text  # noqa: F401  (registers the query)
    from basketflow.plans.catalog import oracle_sql, queries

    rows = [(1, "a bb a", "en"), (2, "", "en"), (3, "  \n ", "de"), (4, "##@@##z", "en"), (5, " one ##@@## two", "en")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries()["sentence_tokens"](spark, str(tmp_path))
    found = {r[0]: tuple(r[1:]) for r in got.collect()}
    assert found == {1: ("en", 3, 2, 1, "a", "a"), 2: ("en", 0, 0, 0, None, None), 3: ("de", 0, 0, 0, None, None),
                     4: ("en", 0, 0, 0, None, None), 5: ("en", 1, 1, 1, "one", "one")}
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert found == {r[0]: r[1:] for r in con.execute(oracle_sql()["sentence_tokens"]).fetchall()}
