"""Toxicity by a weighted pattern grammar over clauses.

Two transducers are composed. The lexicon reads words and writes symbols: insult, threat, target,
negation, reported speech. The clause grammar reads these symbols and writes, for each insult or
threat, the context it stands in: plain, aimed at a target, negated or reported. A match weighs
-log(1 - p * m), p the toxic share of the documents with that lexicon entry, m the factor of its
context; of a clause the heaviest match counts, and the weights of clauses add up. A logistic curve
over that sum, the number of matched clauses and the length of the document gives the score: one
chance match in a long document means less than several in a short one.

All is fitted on labelled documents: words and stems whose contexts are those of toxic documents
beyond chance join the given seed words; then the words that take the offence out of the clauses they
stand in, before the match, or put it there, join the negations and the targets; then the factors; then
the curve.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from footfall.llm.common import ship_by_value
from footfall.sources.storage import materialise

ship_by_value(__name__)

#: Seed words of the transducers in English, German, French and Spanish; * marks a stem.
SEEDS = {
    "insult": (
        "asshole bastard bitch dumbass fool idiot* imbecile loser moron* pathetic scum stupid trash worthless disgusting "
        "arschloch dummkopf trottel vollidiot wichser abschaum connard* imbécile* salaud salope ordure "
        "cabrón estúpido estúpida gilipollas imbécil pendejo"
    ),
    "threat": (
        "kill murder strangle stab shoot hurt töten umbringen erschießen verprügeln tuer buter égorger "
        "matar matarte asesinar golpear"
    ),
    "target": (
        "you your yours yourself they them their he him she her du dich dir dein deine ihr euch sie "
        "tu toi te vous ton ta tes ils eux elle usted ustedes ti tus vosotros ellos ella"
    ),
    "negation": "not no never isn aren wasn don doesn nor kein keine nicht nie niemals pas jamais aucun ni nunca jamás",
    "reported": (
        "said says say told called calls claimed claims wrote quoted sagte sagt nannte schrieb behauptet "
        "dit disait appelé écrit affirme dijo dice llamó escribió afirma"
    ),
}
WORD = re.compile(r"[^\W\d_]+")
CLAUSE_END = re.compile(r"[.!?;:\n()\"“”«»]")
STEM_SIZES = (4, 5, 6, 7, 8)
#: A negation reaches this many words.
REACH = 4
CONTEXTS = ("plain", "aimed", "negated", "reported")
#: Factors before any data, and how many documents they count for.
PRIOR = {"plain": 0.9, "aimed": 1.0, "negated": 0.5, "reported": 0.5}
STRENGTH = 4.0

#: The clause grammar: (state, symbol) -> state. Other symbols leave the state as it is.
GRAMMAR = {
    ("plain", "target"): "aimed", ("plain", "negation"): "negated", ("plain", "reported"): "reported",
    ("aimed", "negation"): "negated", ("aimed", "reported"): "reported",
    ("negated", "reported"): "reported",
}


@dataclass
class Model:
    """Shares of toxic documents per insult or threat entry, factors of contexts, weights of the curve."""

    words: dict[str, tuple[str, float]] = field(default_factory=dict)
    stems: dict[str, tuple[str, float]] = field(default_factory=dict)
    factors: dict[str, float] = field(default_factory=lambda: dict(PRIOR))
    curve: tuple[float, ...] = ()

    def symbol(self, word: str) -> tuple[str, float] | None:
        found = self.words.get(word)
        if found is None:
            for n in reversed(STEM_SIZES):
                if (found := self.stems.get(word[:n])) is not None:
                    break
        return found


def seed_model() -> Model:
    model = Model()
    for symbol, entries in SEEDS.items():
        for entry in entries.split():
            table = model.stems if entry.endswith("*") else model.words
            word = entry.rstrip("*")
            if entry.endswith("*") and len(word) not in STEM_SIZES:
                word = word[:STEM_SIZES[-1]]
            table[word] = (symbol, 0.7 if symbol == "insult" else 0.5)
    return model


def matches(text: str, model: Model) -> list[tuple[str, str, float]]:
    """(entry, context, share) per matched clause, the heaviest match of it."""
    low = text.lower()
    marked = {w: s for w in set(WORD.findall(low)) if (s := model.symbol(w)) is not None}
    if not any(s[0] in ("insult", "threat") for s in marked.values()):
        return []
    out = []
    for clause in CLAUSE_END.split(low):
        state, reach, found, aimed = "plain", 0, [], False
        for word in WORD.findall(clause):
            if state == "negated":
                reach -= 1
                if reach == 0:
                    state = "aimed" if aimed else "plain"
            symbol = marked.get(word)
            if symbol is None:
                continue
            kind, share = symbol
            if kind in ("insult", "threat"):
                found.append((word, kind, state, share))
                continue
            aimed |= kind == "target"
            state = GRAMMAR.get((state, kind), state)
            if kind == "negation":
                reach = REACH
        if aimed:  # a target after the insult aims it too
            found = [(w, k, "aimed" if s == "plain" else s, p) for w, k, s, p in found]
        # a threat without a target is no threat
        found = [(w, s, p) for w, k, s, p in found if k == "insult" or aimed]
        if found:
            out.append(max(found, key=lambda m: m[2] * model.factors[m[1]]))
    return out


def features(text: str, model: Model) -> tuple[list[tuple[str, str, float]], list[float]]:
    """The matches of a text, and what the curve sees of them."""
    found = matches(text, model)
    total = -sum(math.log1p(-min(0.999, p * model.factors[c])) for _, c, p in found)
    words = math.log1p(text.count(" ") + text.count("\n"))
    return found, [1.0, float(bool(found)), total, math.log1p(total), math.log1p(len(found)), words / 10, total / (1 + words)]


def score(seen: list[float], model: Model) -> float:
    """Chance of label 1; without a fitted curve the chance that one clause at least is toxic."""
    if not model.curve:
        return 1.0 - 0.98 * math.exp(-seen[2])
    z = sum(a * b for a, b in zip(seen, model.curve))
    return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))


# -- fitting -------------------------------------------------------------------------------------------

def held_out(doc_id: Column) -> Column:
    """crc32 of the doc_id as text, modulo 4, is 2. A null doc_id is an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def training_rows(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """(text, toxic) of at most ``most`` labelled documents outside the held-out part, those with the
    smallest hash of the doc_id. Of several labels of a document the largest counts."""
    known = labels.filter(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id").select("text", "toxic")


def _evidence(n: float, t: float, prior: float) -> float:
    """Nats by which a share of t of n toxic documents is beyond the prior (Chernoff bound)."""
    share = t / n
    if share <= prior:
        return 0.0
    rest = 0.0 if share >= 1 else (1 - share) * math.log((1 - share) / (1 - prior))
    return n * (share * math.log(share / prior) + rest)


def _word_counts(rows: DataFrame) -> DataFrame:
    """(entry, n, t): contexts of each word, and those of them that only toxic documents have.

    A context is the word before and the word after. Copies of a passage share their contexts, so they
    count once, however many documents hold them and however each copy was edited elsewhere."""
    w = F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), 1)
    places = F.transform(F.sequence(F.lit(0), F.size("w") - 1), lambda i: F.struct(
        F.get("w", i).alias("entry"), F.xxhash64(F.get("w", i - 1), F.get("w", i + 1)).alias("context"),
    ))
    found = rows.select("toxic", w.alias("w")).filter(F.size("w") > 0).select("toxic", F.inline(places))
    contexts = found.groupBy("entry", "context").agg(F.min("toxic").alias("toxic"))
    return contexts.groupBy("entry").agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("t"))


def _stem_counts(words: DataFrame) -> DataFrame:
    """(entry, n, t, words): the same for stems, and how many of the stem's words toxic documents have.

    The most frequent of these words is left out of n and t: a stem has to hold without it."""
    stems = F.filter(
        F.array(*[F.when(F.length("entry") > k, F.substring("entry", 1, k)) for k in STEM_SIZES]),
        lambda stem: stem.isNotNull(),
    )
    each = words.select(F.explode(stems).alias("stem"), "n", "t").groupBy("stem")
    top = F.max(F.struct("t", "n"))
    return each.agg(
        (F.sum("n") - top.n).alias("n"), (F.sum("t") - top.t).alias("t"),
        F.count_if(F.col("t") > 0).alias("words"),
    ).withColumnRenamed("stem", "entry")


def _evidence_column(n: Column, t: Column, prior: float) -> Column:
    """``_evidence`` of columns, for shares above the prior."""
    share = t / n
    rest = F.when(t < n, (1 - share) * F.log((1 - share) / (1 - prior))).otherwise(0.0)
    return F.when(share > prior, n * (share * F.log(share / prior) + rest)).otherwise(0.0)


def fit(docs: DataFrame, labels: DataFrame, most: int = 20_000) -> Model:
    """The model from at most ``most`` labelled documents. Without labels, the seeds and the priors.

    Every entry with enough evidence counts: their number is bounded by that of the labelled documents'
    words."""
    model = seed_model()
    rows = materialise(training_rows(docs, labels, most), "labelled")
    total, toxic = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not total or not toxic or toxic == total:
        return model
    words = materialise(_word_counts(rows), "words")
    entries, n, t = words.agg(F.count(F.lit(1)), F.sum("n"), F.sum("t")).first()
    if not t:
        return model
    prior = t / n
    needed = math.log((1 + len(STEM_SIZES)) * entries) + 5  # about one chance entry in 150 fits
    counts = words.select("entry", F.lit(False).alias("stem"), "n", "t", F.lit(1).cast("bigint").alias("words"))
    stemmed = _stem_counts(words).select("entry", F.lit(True).alias("stem"), "n", "t", "words")
    strong = counts.unionByName(stemmed).filter((F.col("t") > 2 * prior * F.col("n")) & F.expr("2 * t >= n AND t >= 3"))
    found = strong.filter(_evidence_column(F.col("n"), F.col("t"), prior) > needed).orderBy(F.desc("t"), "entry", "stem").collect()
    stems = {r.entry: r for r in found if r.stem and r.words >= 3 and r.t >= 0.6 * r.n}
    for entry, r in sorted(stems.items(), key=lambda x: len(x[0])):
        wider = [stems[entry[:k]] for k in STEM_SIZES if k < len(entry) and entry[:k] in stems and entry[:k] in model.stems]
        # a longer stem joins a shorter one only if its share is clearly higher
        if not wider or r.t / r.n > wider[-1].t / wider[-1].n + 0.1:
            model.stems[entry] = ("insult", (r.t + 1) / (r.n + 2))
    for r in found:
        kind = model.words.get(r.entry, ("insult", 0.0))[0]
        if not r.stem and kind in ("insult", "threat"):
            model.words[r.entry] = (kind, (r.t + 1) / (r.n + 2))
    # seed entries with data take their share from it
    seeds = [w for w, (k, _) in model.words.items() if k in ("insult", "threat")]
    for r in words.filter(F.col("entry").isin(seeds)).collect():
        kind = model.words[r.entry][0]
        model.words[r.entry] = (kind, (r.t + 1) / (r.n + 2))
    _learn_surroundings(rows, model)
    _fit_contexts(rows, model)
    _fit_curve(rows, model)
    return model


def surroundings(text: str, model: Model) -> list[tuple[str, str]]:
    """(word, clause) of the words up to REACH before the first insult of a text's one plain or aimed clause.

    Texts with several matched clauses tell nothing of one of them, clauses with a known negation or report
    nothing of other words."""
    low, found = text.lower(), matches(text, model)
    if len(found) != 1 or found[0][1] not in ("plain", "aimed"):
        return []
    for clause in CLAUSE_END.split(low):
        words = WORD.findall(clause)
        kinds = [(model.symbol(w) or ("",))[0] for w in words]
        if "insult" in kinds:
            at = kinds.index("insult")
            near = {w for w, k in zip(words[max(0, at - REACH):at], kinds[max(0, at - REACH):at]) if not k}
            return [(w, " ".join(words)) for w in sorted(near)]
    return []


def _learn_surroundings(rows: DataFrame, model: Model) -> None:
    """Words that stand before an insult and change the share of toxic documents: where it falls to half or
    less, beyond chance, they negate; where it rises beyond chance, they aim. Equal clauses count once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = [(w, c, t) for text, t in zip(*(c.to_pylist() for c in batch.columns)) for w, c in surroundings(text, model)]
            words, clauses, toxic = zip(*seen) if seen else ([], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(clauses, pa.string()), pa.array(toxic, pa.int64())], names=["word", "clause", "toxic"])

    each = rows.select("text", F.col("toxic").cast("bigint")).mapInArrow(run, "word string, clause string, toxic bigint")
    each = materialise(each.groupBy("word", F.xxhash64("clause").alias("clause")).agg(F.max("toxic").alias("toxic")), "surroundings")
    clauses = each.groupBy("clause").agg(F.max("toxic").alias("toxic"))
    n, t, words = clauses.agg(F.count(F.lit(1)), F.sum("toxic")).first() + (each.agg(F.count_distinct("word")).first()[0],)
    if not t or t == n:
        return
    share, needed = t / n, math.log(2 * words) + 5  # about one chance word in 150 fits
    counts = each.groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("t"))
    n_, t_ = F.col("n"), F.col("t")
    harmless = (2 * t_ <= share * n_) & (_evidence_column(n_, n_ - t_, 1 - share) > needed)
    worse = _evidence_column(n_, t_, share) > needed
    for r in counts.select("word", harmless.alias("harmless"), worse.alias("worse")).filter("harmless OR worse").collect():
        model.words[r.word] = ("negation" if r.harmless else "target", 0.0)


def _fit_contexts(rows: DataFrame, model: Model) -> None:
    """Toxic share of documents by the one context of their matches, against that of plain matches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = []
            for text in batch.column(0).to_pylist():
                seen = {context for _, context, _ in matches(text, model)}
                kinds.append("none" if not seen else seen.pop() if len(seen) == 1 else "several")
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), batch.column(1).cast(pa.int64())], names=["context", "toxic"])

    seen = rows.select("text", "toxic").mapInArrow(run, "context string, toxic bigint")
    counts = {r.context: (r.n, r.t) for r in seen.groupBy("context").agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("t")).collect()}
    for context in CONTEXTS:
        n, t = counts.get(context, (0, 0))
        model.factors[context] = min(1.0, (t + STRENGTH * PRIOR[context]) / (n + STRENGTH))


def _fit_curve(rows: DataFrame, model: Model) -> None:
    """Logistic regression by Newton steps with a small ridge, on a few numbers per labelled document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = [features(t, model)[1] for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(seen, pa.list_(pa.float64())), batch.column(1).cast(pa.int64())], names=["x", "toxic"])

    made = rows.select("text", "toxic").mapInArrow(run, "x array<double>, toxic bigint")
    # equal rows are one with a number: documents without a match differ in length only
    kinds = made.groupBy(F.transform("x", lambda v: F.round(v, 2)).alias("x"), "toxic").agg(F.count(F.lit(1)).alias("n")).orderBy("x", "toxic").collect()
    x = np.array([r.x for r in kinds])
    y, n = np.array([r.toxic for r in kinds], float), np.array([r.n for r in kinds], float)
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (n * (y - p)) - 0.1 * w
        bend = (x * (n * p * (1 - p) + 1e-9)[:, None]).T @ x + 0.1 * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w += step * min(1.0, 5.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    model.curve = tuple(float(v) for v in w)


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """Per row doc_id, held_out, score, predicted and the matches (entry, context). A null or empty
    text has the score of a document without a match. No rows give no rows."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    kind = pa.list_(pa.struct([("entry", pa.string()), ("context", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = [features(t or "", model) for t in batch.column(1).to_pylist()]
            hits = [[{"entry": e, "context": c} for e, c, _ in found] for found, _ in seen]
            scores = [score(x, model) for _, x in seen]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array(hits, kind)], names=["doc_id", "score", "matches"])

    rows = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, score double, matches array<struct<entry: string, context: string>>")
    predicted = F.when(F.col("score") >= 0.3, 1).otherwise(0)
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"), "matches")
