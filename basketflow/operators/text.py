"""Text operators over whole documents.

Long form first: (doc, word) rows, so every step is a join or a
map-side-combined aggregate; a sparse vector per document is only
assembled at the end, bounded by that document's distinct words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketflow.functions import text as T
from basketflow.operators.meet import partitions_for
from basketflow.operators.prefix import running_totals
from basketflow.session import cut_lineage

HASH_FEATURES = 1 << 18  # fixed: 2^18 hash buckets
MIN_DOC_FREQ = 2  # fixed: IDF minimum document frequency


def _explode_words(c, keep: list) -> "callable":
    # explode the raw split, then drop empty strings with a plain (codegen'd)
    # filter instead of a per-element lambda
    return lambda df: df.select(*keep, F.explode(F.split(c, T.WHITESPACE)).alias("word")) \
                        .filter(F.col("word") != "")


def _counts(df: DataFrame, id_col: str, toks: Column, word: str, n: str) -> DataFrame:
    """``id_col, word, n``: how often each of the tokens ``toks`` (an array over the columns of ``df``) occurs per id.

    With one row per id (a look at the ids alone tells) each text is counted where it is, with no shuffle: its sorted
    tokens are runs of equal ones, and a run's start and the next one's give its word and length.  A repeated id may
    hold much of the table, so its rows are counted per task and then summed."""
    ids = df.groupBy(id_col).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()
    if ids[0] is None or ids[0] > 1:
        return df.select(id_col, F.explode(toks).alias(word)).groupBy(id_col, word).agg(F.count(F.lit(1)).alias(n))
    places = F.when(F.size("_s") > 0, F.sequence(F.lit(0), F.size("_s") - 1))
    runs = df.select(id_col, F.sort_array(toks).alias("_s")).select(id_col, "_s", F.filter(
        places, lambda i: (i == 0) | (F.get("_s", i) != F.get("_s", i - 1))).alias("_at"))
    # (outer: Spark adds no filter that would sort and cut every text a second time)
    ends = F.slice("_at", 2, F.size("_at")).alias("_to")
    runs = runs.select(id_col, "_s", F.explode_outer(F.arrays_zip("_at", ends)).alias("_e")).filter("_e is not null")
    return runs.select(id_col, F.get("_s", F.col("_e._at")).alias(word),
                       (F.coalesce("_e._to", F.size("_s")) - F.col("_e._at")).cast("long").alias(n))


def words(df: DataFrame, col: str, id_col: str | None = None) -> DataFrame:
    """One row per word occurrence (``id_col`` kept when given)."""
    keep = [id_col] if id_col else []
    return _explode_words(F.col(col), keep)(df)


def word_count(df: DataFrame, col: str) -> DataFrame:
    """``word, cnt`` (partial counts per task, then one shuffle)."""
    return words(df, col).groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


def top_words(counts: DataFrame, k: int = 20) -> DataFrame:
    """The k most frequent words, ties by word (TakeOrderedAndProject)."""
    return counts.orderBy(F.col("cnt").desc(), F.col("word").asc()).limit(k)


def sentence_tokens(sent: DataFrame) -> DataFrame:
    """Per sentence, token counts of the label-stripped body (no token: counts of 0, and no first or last)."""
    toks = T.tokens(T.sentence_body(F.col("sentence")))
    return sent.select(
        "doc_id", T.sentence_label(F.col("sentence")).alias("label"),
        F.size(toks).alias("n_tokens"),
        F.size(F.array_distinct(toks)).alias("n_distinct"),
        F.size(F.filter(toks, lambda x: F.length(x) > 1)).alias("n_long"),
        F.try_element_at(toks, F.lit(1)).alias("first_token"),
        F.try_element_at(toks, F.lit(-1)).alias("last_token"))


def segment(df: DataFrame, col: str, out: str = "seg", segmenter=None) -> DataFrame:
    """``df`` plus ``out`` = segments longer than one character joined by '/'.

    The default segmenter is a built-in regex split (JVM side).  Any other
    segmenter -- e.g. a dictionary segmenter wrapped as a pandas UDF returning
    ``array<string>`` -- can be passed as ``segmenter`` (a function from a
    Column to an array Column); the length filter and the joining stay the
    same."""
    if segmenter is None:
        return df.withColumn(out, T.segment_string(F.col(col)))
    toks = F.filter(segmenter(F.col(col)), lambda x: F.length(x) > 1)
    return df.withColumn(out, F.array_join(toks, T.SEGMENT_JOINER))


def segment_index_terms(df: DataFrame, col: str, id_col: str) -> DataFrame:
    """F10 (re-aimed INDEX mode): 2- and 3-character substrings inside longer
    segments that are words of the corpus themselves; ``id, term, n``.

    The dictionary is the set of distinct 2-3 character segments -- a
    left-semi join, broadcast by the planner only when its size allows.  Tokens
    are counted per document first and cut into substrings once per distinct
    token, so no substring of a token's every occurrence is shuffled."""
    seg = cut_lineage(_counts(df.select(id_col, col), id_col, T.segments(F.col(col)), "tok", "c"))
    distinct = seg.select("tok").distinct()
    vocab = distinct.filter(F.length("tok").between(2, 3)).select(F.col("tok").alias("term"))
    subs = distinct.filter(F.length("tok") > 2).select("tok", F.explode(T.inner_terms(F.col("tok"))).alias("term")) \
        .groupBy("tok", "term").agg(F.count(F.lit(1)).alias("m")).join(vocab, "term", "left_semi")
    # a token's terms are one short list, so rows multiply only where their document is summed; written, so
    # that their number gives the number of partitions
    lists = subs.groupBy("tok").agg(F.collect_list(F.struct("term", "m")).alias("_terms"))
    met = cut_lineage(seg.join(lists, "tok").select(id_col, "c", "_terms"))
    n = partitions_for(met, met.agg(F.sum(F.size("_terms"))).first()[0] or 0)
    return met.repartition(n, id_col).select(id_col, "c", F.inline("_terms")) \
        .groupBy(id_col, "term").agg(F.sum(F.col("c") * F.col("m")).alias("n"))


def doc_freq(sent: DataFrame) -> DataFrame:
    """``word, df`` = number of documents containing the word.

    Words are made distinct inside a row first, so with one row per document (a look at the
    ids alone tells) only partial counts per word are shuffled; repeated ids count once."""
    toks = F.array_distinct(T.tokens(T.sentence_body(F.col("sentence"))))
    rows = sent.select("doc_id", F.explode(toks).alias("word"))
    if not sent.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
        rows = rows.distinct()
    return rows.groupBy("word").agg(F.count(F.lit(1)).alias("df"))


def term_freq(sent: DataFrame) -> DataFrame:
    """``doc_id, word, tf``."""
    return _counts(sent.select("doc_id", "sentence"), "doc_id", T.tokens(T.sentence_body(F.col("sentence"))), "word", "tf")


def vocab_index(dfreq: DataFrame) -> DataFrame:
    """``word, word_index`` (0-based, in word order) and ``dict_size``.

    The numbering is a distributed running count (sampled ranges + offsets), not a single-task global window; no separate job."""
    v = running_totals(dfreq, ["word"], count_col="_pos", total_col="dict_size")
    return v.withColumn("word_index", F.col("_pos") - 1).drop("_pos")


def _counted_terms(sent: DataFrame) -> tuple[DataFrame, int]:
    """Term frequencies, written once to the shared folder (they are read by join, DF and numbering), and the
    number of documents.  The count reads no text (column pruning leaves row counts or ids); an observed
    metric would save even that, but counts rows again when a lost executor's tasks are repeated."""
    return cut_lineage(term_freq(sent)), sent.count()


def tfidf_exact(sent: DataFrame, with_size: bool = False) -> DataFrame:
    """F14 (D13, D14): ``tf * log10(N / (df + 1))`` per (doc, word), with the
    word's dictionary index; N is the corpus size (one scalar)."""
    tf, n_docs = _counted_terms(sent)
    # document frequency = number of (doc, word) rows per word
    vocab = vocab_index(tf.groupBy("word").agg(F.count(F.lit(1)).alias("df")))
    return tf.join(vocab, "word").select(
        "doc_id", "word", "word_index", "tf", "df", *(["dict_size"] if with_size else []),
        F.round(F.col("tf") * F.log10(F.lit(float(n_docs)) / (F.col("df") + 1)), 9).alias("weight"))


#: Distinct words of a partition that are held in memory to be met by its rows; more are sorted.
HELD_WORDS = 250_000


def tfidf_smoothed(sent: DataFrame) -> DataFrame:
    """F12 long form: ``tf * ln((N + 1) / (df + 1))``, 0 when df < 2.

    The logarithm is taken once per word, and the weight of a single occurrence is rounded once per word.  Rows
    meet their word in a hash table if a partition's words fit (they are counted beforehand), and are then sorted by
    the word's hash, a number: equal words stand together in the result, as after a sort by word, which costs far more."""
    tf, n_docs = _counted_terms(sent)
    idf = F.log((F.lit(float(n_docs)) + 1) / (F.col("df") + 1))
    dfreq = cut_lineage(tf.groupBy("word").agg(F.count(F.lit(1)).alias("df")))
    held = dfreq.count() <= HELD_WORDS * int(dfreq.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dfreq = dfreq.select("word", "df", idf.alias("_idf"), F.round(idf, 9).alias("_once"))
    out = tf.join(dfreq.hint("shuffle_hash") if held else dfreq, "word").select(
        "doc_id", "word", "tf", "df",
        F.when(F.col("df") < MIN_DOC_FREQ, F.lit(0.0)).when(F.col("tf") == 1, F.col("_once"))
         .otherwise(F.round(F.col("tf") * F.col("_idf"), 9)).alias("weight"))
    return out.sortWithinPartitions(F.xxhash64("word")) if held else out


def tfidf_vectors(long_form: DataFrame, size_col: str = "dict_size") -> DataFrame:
    """F14 vector form: per document ``sort_array(collect_list(struct(index,
    weight)))`` -- bounded by the document's distinct words -- and the vector's size."""
    # plain rows are dealt out by document: they come in word order, so neighbours share index and weight and
    # compress, which the half-collected arrays of a document do not
    return long_form.select("doc_id", size_col, "word_index", "weight").repartition("doc_id").groupBy("doc_id").agg(
        F.max(size_col).alias(size_col), F.sort_array(F.collect_list(F.struct("word_index", "weight"))).alias("entries"))


def tfidf_hashed(sent: DataFrame) -> DataFrame:
    """F11 + F12 with Spark ML: HashingTF (2^18, counts) then IDF(minDocFreq=2).

    Output ``doc_id, feature_tfidf`` (the sparse vector) and its summary
    ``n_terms, l2``, taken from the vector's own entries by built-ins."""
    from pyspark.ml.feature import HashingTF, IDF

    seg = sent.select("doc_id", T.tokens(T.sentence_body(F.col("sentence"))).alias("seg"))
    tf = HashingTF(inputCol="seg", outputCol="feature_tf", numFeatures=HASH_FEATURES, binary=False).transform(seg)
    model = IDF(inputCol="feature_tf", outputCol="feature_tfidf", minDocFreq=MIN_DOC_FREQ).fit(tf)
    values = F.from_json(F.to_json("v"), "struct<v:struct<type:int,size:int,indices:array<int>,values:array<double>>>")
    out = model.transform(tf).select("doc_id", "feature_tfidf", F.struct(F.col("feature_tfidf").alias("v")).alias("v"))
    return out.withColumn("x", F.filter(values["v"]["values"], lambda e: e != 0)).select(
        "doc_id", "feature_tfidf", F.size("x").alias("n_terms"),
        F.sqrt(F.aggregate("x", F.lit(0.0), lambda s, e: s + e * e)).alias("l2"))


#: Words in more documents than this are dense: with any of them, documents meet in blocks.
DENSE_WORD = 200


def doc_neighbours(long_form: DataFrame, k: int = 10, dense: int = DENSE_WORD) -> DataFrame:
    """the k most similar documents by cosine of their weight vectors
    (:mod:`basketflow.operators.topk`) with word = item (its index, if the rows
    have it) and weight = rating.  ``doc_id, doc_v, sim``."""
    from basketflow.operators.topk import top_cosine
    word = "word_index" if "word_index" in long_form.columns else "word"
    r = long_form.select(F.col("doc_id").alias("user_id"), F.col(word).alias("item_id"),
                         F.col("weight").alias("rating"))
    return top_cosine(r, k, dense).select(F.col("user_id").alias("doc_id"), F.col("user_v").alias("doc_v"), "sim")


def lcs_pairs(conv: DataFrame) -> DataFrame:
    """F16: LCS length and similarity of each turn and the next turn of the
    same conversation (whole texts).  Pairs come from an equi-join on
    (conv_id, turn + 1), so their number is linear in the turns."""
    a = conv.select("conv_id", "turn", F.col("text").alias("text_a"))
    b = conv.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("text_b"))
    p = a.join(b, ["conv_id", "turn"])
    lcs = T.lcs_length_udf(F.col("text_a"), F.col("text_b"))
    n = F.length("text_a") + F.length("text_b")
    return p.select("conv_id", "turn", lcs.alias("lcs"), n.alias("n_chars")).select(
        "conv_id", "turn", "lcs",
        F.when(F.col("n_chars") == 0, F.lit(None).cast("double"))
         .otherwise(F.col("lcs") / (F.col("n_chars") / 2)).alias("similarity"))


__all__ = ["words", "word_count", "top_words", "sentence_tokens", "segment", "segment_index_terms",
           "doc_freq", "term_freq", "vocab_index", "tfidf_exact", "tfidf_smoothed", "tfidf_vectors",
           "tfidf_hashed", "doc_neighbours", "lcs_pairs"]
