"""Text queries over whole documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from basketflow.operators import lattice as L
from basketflow.operators import text as X
from basketflow.plans.catalog import query
from basketflow.plans.oracle_views import exact_sum_sql, with_views
from basketflow.sources.tables import sentences, spread, table

# DuckDB spellings of the token rules in ``functions.text``.
_TOKS = "list_filter(regexp_split_to_array({c}, '\\s+'), lambda x: x <> '')"
_BODY = "split_part({c}, '##@@##', 1)"
_SEGS = "list_filter(regexp_split_to_array({c}, '[^\\p{{L}}\\p{{N}}]+'), lambda x: length(x) >= 2)"
SENT_TOKS = ("v_toks", "select doc_id, " + _TOKS.format(c=_BODY.format(c="sentence"))
             + " as toks from v_sentences")
DOCFREQ = ("v_df", "select word, count(*) as df from "
           "(select doc_id, unnest(list_distinct(toks)) as word from v_toks) t group by word")
TERMFREQ = ("v_tf", "select doc_id, word, count(*) as tf from "
            "(select doc_id, unnest(toks) as word from v_toks) t group by doc_id, word")
NDOCS = "(select cast(count(*) as double) from v_sentences)"


def _docs(spark, sf):
    return spread(table(spark, sf, "documents").select("doc_id", "text"), "doc_id")


@query("word_count", f"""
select word, count(*) as cnt from (select unnest({_TOKS.format(c='text')}) as word from documents) t
group by word""")
def q_word_count(spark, sf):
    return X.word_count(_docs(spark, sf), "text")


@query("top_words", f"""
select word, count(*) as cnt from (select unnest({_TOKS.format(c='text')}) as word from documents) t
group by word order by cnt desc, word limit 20""")
def q_top_words(spark, sf):
    return X.top_words(X.word_count(_docs(spark, sf), "text"), 20)


@query("sentence_tokens", with_views("""
select doc_id, string_split(sentence, '##@@##')[-1] as label,
       cast(len(toks) as integer) as n_tokens,
       cast(len(list_distinct(toks)) as integer) as n_distinct,
       cast(len(list_filter(toks, lambda x: length(x) > 1)) as integer) as n_long,
       toks[1] as first_token, toks[-1] as last_token
from (select doc_id, sentence, """ + _TOKS.format(c=_BODY.format(c="sentence")) + """ as toks
      from v_sentences) t""", "v_sentences"))
def q_sentence_tokens(spark, sf):
    return X.sentence_tokens(sentences(spark, sf))


@query("segment_tokens", "select doc_id, array_to_string(" + _SEGS.format(c="text")
       + ", '/') as seg from documents")
def q_segment_tokens(spark, sf):
    return X.segment(_docs(spark, sf), "text").select("doc_id", "seg")


@query("segment_index_terms", """
with seg as (select doc_id, unnest(""" + _SEGS.format(c="text") + """) as tok from documents),
vocab as (select distinct tok as term from seg where length(tok) between 2 and 3),
subs as (
  select doc_id, substr(tok, s, 2) as term
  from (select doc_id, tok, unnest(range(1, length(tok))) as s from seg where length(tok) > 2) a
  union all
  select doc_id, substr(tok, s, 3) as term
  from (select doc_id, tok, unnest(range(1, length(tok) - 1)) as s from seg where length(tok) > 3) b)
select doc_id, term, count(*) as n from subs where term in (select term from vocab) group by doc_id, term""")
def q_segment_index_terms(spark, sf):
    return X.segment_index_terms(_docs(spark, sf), "text", "doc_id")


@query("doc_freq", with_views("select word, df from v_df", "v_sentences", extra=[SENT_TOKS, DOCFREQ]))
def q_doc_freq(spark, sf):
    return X.doc_freq(sentences(spark, sf))


@query("term_freq", with_views("select doc_id, word, tf from v_tf", "v_sentences", extra=[SENT_TOKS, TERMFREQ]))
def q_term_freq(spark, sf):
    return X.term_freq(sentences(spark, sf))


VOCAB = ("v_vocab", "select word, df, row_number() over (order by word) - 1 as word_index, "
         "count(*) over () as dict_size from v_df")


@query("vocab_index", with_views("select word, df, word_index, dict_size from v_vocab", "v_sentences",
                                 extra=[SENT_TOKS, DOCFREQ, VOCAB]))
def q_vocab_index(spark, sf):
    return X.vocab_index(X.doc_freq(sentences(spark, sf)))


@query("tfidf_exact", with_views(f"""
select t.doc_id, t.word, v.word_index, t.tf, v.df,
       round(t.tf * log10({NDOCS} / (v.df + 1)), 9) as weight
from v_tf t join v_vocab v on t.word = v.word""", "v_sentences", extra=[SENT_TOKS, DOCFREQ, TERMFREQ, VOCAB]))
def q_tfidf_exact(spark, sf):
    return X.tfidf_exact(sentences(spark, sf))


@query("tfidf_smoothed", with_views(f"""
select t.doc_id, t.word, t.tf, d.df,
       case when d.df < 2 then 0.0 else round(t.tf * ln(({NDOCS} + 1) / (d.df + 1)), 9) end as weight
from v_tf t join v_df d on t.word = d.word""", "v_sentences", extra=[SENT_TOKS, DOCFREQ, TERMFREQ]))
def q_tfidf_smoothed(spark, sf):
    return X.tfidf_smoothed(sentences(spark, sf))


@query("tfidf_hashed")
def q_tfidf_hashed(spark, sf):
    """Rows-only: Spark ML HashingTF + IDF vectors, summarised per document."""
    return X.tfidf_hashed(sentences(spark, sf))


@query("lcs_pairs")
def q_lcs_pairs(spark, sf):
    """Rows-only (checked against a plain dynamic programme in the tests)."""
    return X.lcs_pairs(table(spark, sf, "conversations").select("conv_id", "turn", "text"))


_WEIGHTS = ("v_w", f"""
select t.doc_id, t.word, round(t.tf * log10({NDOCS} / (d.df + 1)), 9) as weight
from v_tf t join v_df d on t.word = d.word""")
_DOCNORM = ("v_dn", f"""
select doc_id, sqrt({exact_sum_sql("weight * weight")}) as norm from v_w group by doc_id""")
_DOCDOT = ("v_dd", f"""
select a.doc_id, b.doc_id as doc_v, {exact_sum_sql("a.u * b.u")} as sim
from (select v_w.doc_id, word, weight / norm as u from v_w join v_dn on v_w.doc_id = v_dn.doc_id where norm > 0) a
join (select v_w.doc_id, word, weight / norm as u from v_w join v_dn on v_w.doc_id = v_dn.doc_id where norm > 0) b
  on a.word = b.word and a.doc_id <> b.doc_id group by a.doc_id, b.doc_id""")


@query("doc_cosine", with_views("""
select doc_id, doc_v, round(sim, 6) as sim from (
  select doc_id, doc_v, sim, row_number() over (partition by doc_id order by sim desc, doc_v) as rn from v_dd) t
where rn <= 10""", "v_sentences", extra=[SENT_TOKS, DOCFREQ, TERMFREQ, _WEIGHTS, _DOCNORM, _DOCDOT]))
def q_doc_cosine(spark, sf):
    """ten most similar documents per document (TF-IDF cosine)."""
    nb = X.doc_neighbours(X.tfidf_exact(sentences(spark, sf)).select("doc_id", "word_index", "weight"), 10)
    # ranked on the full value; reported to 6 places (products of large
    # weights are not rounded identically by every engine at 9 places)
    return nb.withColumn("sim", F.round("sim", 6))


@query("tfidf_vectors", with_views("""
select doc_id, any_value(dict_size) as dict_size,
       string_agg(cast(word_index as varchar) || ':' || cast(cast(round(weight * 1000000) as bigint) as varchar), ','
                  order by word_index) as entries
from (select t.doc_id, v.word_index, v.dict_size,
             round(t.tf * log10(""" + NDOCS + """ / (v.df + 1)), 9) as weight
      from v_tf t join v_vocab v on t.word = v.word) x group by doc_id""", "v_sentences",
                                extra=[SENT_TOKS, DOCFREQ, TERMFREQ, VOCAB]))
def q_tfidf_vectors(spark, sf):
    """F14 vector form: a document's sorted ``index:weight`` entries (weights in millionths)."""
    v = X.tfidf_vectors(X.tfidf_exact(sentences(spark, sf), with_size=True))
    entry = lambda e: F.concat(e["word_index"].cast("string"), F.lit(":"),
                               F.round(e["weight"] * 1000000).cast("long").cast("string"))
    return v.select("doc_id", "dict_size", F.array_join(F.transform("entries", entry), ",").alias("entries"))


@query("segment_lattice")
def q_segment_lattice(spark, sf):
    """every distinct token cut by the best path through its word lattice (rows only: the dynamic
    programme has no SQL form; the tests compare it with a plain one)."""
    tokens_ = L.token_counts(_docs(spark, sf), "text")
    words, single = L.dictionary(tokens_)
    return L.segment(tokens_.select("tok"), words, single)


@query("segment_lattice_index", f"""
with seg as (select unnest({_SEGS.format(c="text")}) as tok from documents),
cnt as (select tok, count(*) as n from seg group by tok),
words as (select tok as term from cnt where length(tok) <= 6 and n >= 2),
spans as (select tok, s, unnest(range(2, least(6, length(tok) - s + 1) + 1)) as k
          from (select tok, unnest(range(1, length(tok))) as s from cnt) a)
select distinct tok, term from (select tok, substr(tok, s, k) as term from spans) x
where term <> tok and term in (select term from words)""")
def q_segment_lattice_index(spark, sf):
    """the lattice's inner words as index terms."""
    tokens_ = L.token_counts(_docs(spark, sf), "text")
    words, _ = L.dictionary(tokens_)
    return L.index_terms(tokens_.select("tok"), words)
