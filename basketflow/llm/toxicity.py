"""Toxicity scores from a weighted finite-state pattern grammar.

* Insult transducer: a lexicon of word beginnings and whole words with
  weights, learned from labelled rows.  Evidence for a unit is the number of
  distinct *contexts* (word, word before it) in toxic and in clean rows, so
  copies of one passage count once; a unit is kept by the lower bound of its
  log odds, and of nested units the best one.
* Threat, target, negation and reported-speech transducers: small closed word
  classes in four languages.  They read the tag sequence of a clause and pass
  insults and threats on with a changed weight: after a negator or inside
  reported speech they count less, next to an addressed person more.  The
  machines are composed once into one deterministic transducer.
* A document's features are sums over its matched clauses (not over isolated
  words); a ridge logistic function of them, fitted on labelled rows that the
  lexicon has not seen, is the score.

Labels come only from rows with ``crc32(id) mod 5 <> 0``; a bounded sample of
about ``TRAIN_ROWS`` labelled rows is used (documented parameter, taken by a
hash of the id).  Remainders 1 to 3 give the lexicon, remainder 4 the fit.
Null and empty texts have no clause and get the score of no evidence; without
any toxic label the lexicon is empty.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketflow.llm.common import fresh, let, stage, strings, with_fields

TRAIN_ROWS = 12_000        # labelled rows used at most (about)
MAX_UNITS = 5_000          # lexicon entries kept at most, best first
MIN_CONTEXTS = 6           # toxic contexts a unit needs
MIN_BOUND = 2.5            # lower bound of the log odds that a unit needs
MIN_LEN, MAX_LEN = 3, 10   # length of a word beginning

# Closed word classes (English, German, French, Spanish).
THREATS = ("kill", "murder", "hurt", "strangle", "shoot", "stab", "töten", "umbringen", "erschießen", "verprügeln",
           "tuer", "tuerai", "frapper", "égorger", "matar", "mataré", "golpear", "degollar")
TARGETS = ("you", "your", "he", "she", "they", "him", "her", "them", "du", "dich", "dir", "ihr", "euch", "er", "sie",
           "tu", "te", "toi", "vous", "il", "elle", "eux", "usted", "ti", "él", "ella", "ellos", "vosotros")
NEGATORS = ("not", "no", "never", "isn", "aren", "wasn", "nor", "nicht", "kein", "keine", "nie", "pas", "jamais",
            "aucun", "nunca", "jamás", "ningún", "tampoco")
REPORTERS = ("said", "says", "say", "called", "quoted", "wrote", "claims", "claimed", "reported", "sagte", "sagt",
             "nannte", "schrieb", "behauptet", "dit", "disait", "écrit", "prétend", "dijo", "dice", "llamó", "escribió")

WORD = re.compile(r"[^\W_]+")
CLAUSE = re.compile(r"[.!?;\n]+")

# --- transducers over tags ----------------------------------------------------
# Tags: I insult, H threat, Y target, N negator, R reporter, O other word.
TAGS = "IHYNRO"


@dataclass
class Transducer:
    """Deterministic weighted transducer: (state, tag) -> (state, tag out, factor)."""

    start: int
    arcs: dict[tuple[int, str], tuple[int, str, float]]

    def compose(self, after: Transducer) -> Transducer:
        """This machine's output read by ``after``; factors multiply."""
        number, todo, arcs = {(self.start, after.start): 0}, [(self.start, after.start)], {}
        while todo:
            pair = todo.pop()
            for tag in TAGS:
                s, mid, w1 = self.arcs[pair[0], tag]
                t, out, w2 = after.arcs[pair[1], mid]
                if (s, t) not in number:
                    number[s, t] = len(number)
                    todo.append((s, t))
                arcs[number[pair], tag] = (number[s, t], out, w1 * w2)
        return Transducer(0, arcs)


def _window(opener: str, length: int, factor: dict[str, float]) -> Transducer:
    """For ``length`` words after ``opener``, tags in ``factor`` pass with that factor."""
    arcs = {}
    for state in range(length + 1):
        for tag in TAGS:
            nxt = length if tag == opener else max(0, state - 1)
            arcs[state, tag] = (nxt, tag, factor.get(tag, 1.0) if state else 1.0)
    return Transducer(0, arcs)


def grammar() -> Transducer:
    negation = _window("N", 3, {"I": 0.3, "H": 0.2})
    reported = _window("R", 12, {"I": 0.5, "H": 0.3})
    target = _window("Y", 4, {"I": 1.5, "H": 2.0})
    return negation.compose(reported).compose(target)


# --- model -----------------------------------------------------------------------
@dataclass
class Model:
    units: dict[str, float]                  # "abc" a word beginning, "abc$" a whole word
    coef: list[float]                        # intercept and one per feature
    _index: dict = field(default_factory=dict, repr=False)

    def weight(self, word: str) -> float:
        """Weight of the longest unit that the word matches, 0 if none."""
        w = self.units.get(word + "$")
        if w is not None:
            return w
        for k in range(min(MAX_LEN, len(word)), MIN_LEN - 1, -1):
            w = self.units.get(word[:k])
            if w is not None:
                return w
        return 0.0

    def features(self, text: str | None) -> tuple[float, float, float]:
        """(matched insult clauses' weight, their number, threat weight)."""
        if not text:
            return 0.0, 0.0, 0.0
        low = text.lower()
        if not self._index:
            self._index.update(heads={u[:MIN_LEN] for u in self.units}, machine=grammar().arcs, tags={
                **dict.fromkeys(REPORTERS, "R"), **dict.fromkeys(TARGETS, "Y"), **dict.fromkeys(NEGATORS, "N"),
                **dict.fromkeys(THREATS, "H")})
        heads, machine, tags = (self._index[k] for k in ("heads", "machine", "tags"))
        found = set(WORD.findall(low))
        weights = {w: x for w in found if w[:MIN_LEN] in heads and (x := self.weight(w))}
        if not weights and found.isdisjoint(THREATS):
            return 0.0, 0.0, 0.0
        total = clauses = threat = 0.0
        for clause in CLAUSE.split(low):
            words = WORD.findall(clause)
            if not any(w in weights or tags.get(w) == "H" for w in words):
                continue
            state, best, harm, aimed = 0, 0.0, 0.0, False
            for w in words:
                tag = "I" if w in weights else tags.get(w, "O")
                state, out, factor = machine[state, tag]
                aimed = aimed or tag == "Y"
                if out == "I":
                    best += factor * weights[w]
                elif out == "H":
                    harm += factor
            total += best
            clauses += best > 0
            threat += harm if aimed else 0.0      # a threat needs somebody it is aimed at
        return total, clauses, threat

    def score(self, f: np.ndarray) -> np.ndarray:
        z = self.coef[0] + _scaled(f) @ np.array(self.coef[1:])
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _scaled(f: np.ndarray) -> np.ndarray:
    return np.log1p(f)


def remainder(id_col: str) -> Column:
    return F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 5


def _lexicon(train: DataFrame) -> dict[str, float]:
    """Units from rows ``text, toxic``."""
    ws = F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}]+"), 0)
    pairs = let(ws, lambda w: F.transform(w, lambda x, i: F.struct(
        x.alias("word"), F.when(i > 0, w[i - 1]).otherwise(F.lit("")).alias("before"))))
    ctx = train.select("toxic", F.explode(pairs).alias("p")) \
        .select("p.word", "p.before", "toxic").filter(F.length("word") >= MIN_LEN).distinct()
    words = ctx.groupBy("word").agg(F.count_if(F.col("toxic") == 1).alias("n1"),
                                    F.count_if(F.col("toxic") == 0).alias("n0"))
    words = stage(words, "tox-words")
    n1, n0 = words.agg(F.sum("n1"), F.sum("n0")).first()
    if not n1 or not n0:
        return {}
    heads = F.transform(F.sequence(F.lit(MIN_LEN), F.least(F.length("word"), F.lit(MAX_LEN))),
                        lambda k: F.substring(F.col("word"), F.lit(1), k))
    units = words.select(F.explode(F.concat(heads, F.array(F.concat("word", F.lit("$"))))).alias("unit"), "n1", "n0") \
        .groupBy("unit").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")).filter(F.col("n1") >= MIN_CONTEXTS)
    odds = F.log((F.col("n1") + 0.5) / (F.col("n0") + 0.5)) + float(np.log(n0 / n1))
    bound = odds - 1.64 * F.sqrt(1 / (F.col("n1") + 0.5) + 1 / (F.col("n0") + 0.5))
    best = units.select("unit", odds.alias("odds"), bound.alias("bound")).filter(F.col("bound") >= MIN_BOUND) \
        .orderBy(F.desc(F.round("bound", 6)), F.desc(F.length("unit")), "unit").limit(4 * MAX_UNITS).collect()
    kept: dict[str, float] = {}
    inside: set[str] = set()                       # every beginning of a kept unit
    for r in best:                                 # best first; nested units lose
        u = r["unit"]
        heads_of = [u[:k] for k in range(MIN_LEN, len(u))]
        if u not in inside and not any(h in kept for h in heads_of) and len(kept) < MAX_UNITS:
            kept[u] = min(6.0, float(r["odds"]))
            inside.update(heads_of)
    return kept


def _fit(x: np.ndarray, y: np.ndarray) -> list[float]:
    """Ridge logistic regression by Newton steps; the ridge pulls towards the grammar's own weights."""
    prior = np.array([-4.0, 2.0, 2.0, 2.0])
    strength = np.array([0.1, 0.5, 0.5, 1.0])
    a = np.hstack([np.ones((len(x), 1)), _scaled(x)])
    w = prior.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        g = a.T @ (p - y) + strength * (w - prior)
        h = (a * (p * (1 - p))[:, None]).T @ a + np.diag(strength)
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w.tolist()


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic") -> Model:
    """Lexicon and coefficients from labelled rows with remainder 1 to 4."""
    lab = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("toxic")) \
        .filter(F.col("id").isNotNull() & F.col("toxic").isin(0, 1) & (remainder("id") != 0)) \
        .groupBy("id").agg(F.max("toxic").alias("toxic"))
    n = lab.count()
    share = min(1.0, TRAIN_ROWS / max(1, n))
    lab = lab.filter(F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(1_000_000)) < int(share * 1_000_000))
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    # at most about TRAIN_ROWS rows of 12 bytes: a proven bound for the broadcast
    train = stage(texts.join(F.broadcast(lab), "id").withColumn("rem", remainder("id"))
                  .select("text", "toxic", "rem"), "tox-train")
    model = Model(_lexicon(train.filter("rem <= 3").select("text", "toxic")), [-4.0, 2.0, 2.0, 2.0])
    seen = _features(train.filter("rem = 4").select("text", "toxic"), model, "text").select("f", "toxic").toPandas()
    if len(seen):                                  # about TRAIN_ROWS / 4 rows
        model.coef = _fit(np.array(seen["f"].tolist(), float), seen["toxic"].to_numpy(float))
    return model


def _features(df: DataFrame, model: Model, text_col: str, out: str = "f", keep_text: bool = False) -> DataFrame:
    schema = with_fields(df.schema, [T.StructField(out, T.ArrayType(T.DoubleType()))], () if keep_text else (text_col,))
    carried = [n for n in schema.names if n != out]
    units, coef = model.units, model.coef
    given = fresh(df, "text_in")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(units, coef)
        for batch in batches:
            f = [list(m.features(x)) for x in strings(batch.column(given))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in carried] + [pa.array(f, pa.list_(pa.float64()))], names=schema.names)

    return df.select(*[F.col(f"`{c}`") for c in carried], F.col(f"`{text_col}`").cast("string").alias(given)) \
        .mapInArrow(run, schema)


def score(df: DataFrame, model: Model, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """Add ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on)."""
    rest = df.select(*[F.col(f"`{c}`") for c in df.columns if c not in ("score", "predicted") or c == text_col])
    name = fresh(rest, "features")
    f = _features(rest, model, text_col, out=name, keep_text=keep_text)
    z = F.lit(float(model.coef[0]))
    for k, c in enumerate(model.coef[1:]):
        z = z + F.log1p(F.col(name)[k]) * float(c)
    s = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z))))
    return f.withColumn("score", s).withColumn("predicted", (F.col("score") >= 0.5).cast("int")).drop(name)


def keep(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows not predicted toxic, unchanged (columns called score or predicted included)."""
    names = df.columns
    packed = df.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))
    return score(packed, model, "text", keep_text=False).filter("predicted = 0").select("row.*")
