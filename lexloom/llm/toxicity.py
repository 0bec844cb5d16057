"""Toxicity by a weighted finite-state pattern grammar.

A lexical transducer reads words and writes classes (insult, threat, target, negation, reported speech, intent, other).
Five clause transducers are composed with it: they mark abuse that is aimed at a target, negated, reported, stacked upon
other insults, or threatened by a verb of intent. Arcs carry factors (FACTORS) by which they scale the weight of the word
that they mark. The composed machine reads a clause and accepts it under one pattern (PATTERNS), with the weight of its
whole path; a document's evidence are its clauses, by pattern, and a logistic model fits one weight a pattern.

What counts is the matched clause. A clause in which a single insult stands without target, stack or intent matches only
the pattern "lone"; its weight is 0 unless labelled text teaches another (PRIOR).

Words of abuse are seeds (below) and what labelled text teaches: words and word beginnings that toxic documents hold and
others don't; these are read as insults. Training reads a bounded sample of labelled rows (`SAMPLE`, least hash first),
which is written once; every feature of it is counted, and those whose rates differ enough, LEXICON at most, reach the
driver, as do SAMPLE rows of evidence. Scoring reads every whole text, keeps one automaton per worker, shuffles nothing.

Defined cases: a null or empty text has no clause and scores as a document without evidence; a null id has no label and
counts as not held out; rows of labels with the same id count once, toxic if any is; repeated rows give repeated rows;
other columns are ignored, and kept by `reject`, which keeps a text that it scores below the threshold, null ones too;
without labels of both kinds the seeds alone decide, by the fixed weights of PRIOR; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, small_batches, table

SAMPLE = 20_000
LEXICON = 2_000
#: A learnt entry is found so many times in toxic documents, and there so many times as often as in others, by the
#: lower bound of that many standard deviations.
MIN_TOXIC, MIN_RATIO, DEVIATIONS = 8, 4.0, 2.0
#: In training a word of one document counts so often at most, so that one repetitive document teaches nothing.
PER_DOCUMENT = 3
PREFIXES = range(3, 10)

# Seed words, by class.
INSULT = "idiot moron stupid loser scum trash clown pathetic worthless disgusting dumb fool vermin imbecile crétin abruti connard idiota imbécil estúpido dummkopf trottel abschaum"
THREAT = "kill murder hurt destroy burn stab shoot strangle tuer détruire töten umbringen matar destruir"
TARGET = "you your yours u they them he him she her people vous tu toi ils elles du dich dir ihr euch sie tú ti usted ustedes vosotros"
NEGATION = "not never no isn't aren't don't without ne pas jamais nicht kein keine nie sin nunca jamás"
REPORTED = "said says say called claimed quoted wrote reported dit disait appelé sagte sagt nannte schrieb dijo dice llamó escribió"

INTENT = "will shall must gonna going want should deserve deserves vais va werde wird voy vamos"

CLASSES = ("insult", "threat", "target", "negation", "reported", "intent", "other")
INSULT_, THREAT_, TARGET_, NEGATION_, REPORTED_, INTENT_, OTHER_ = range(7)
CLAUSE_END = re.compile(r"[.!?;:\n]+")
WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")
#: How many words a negation reaches, and a verb of intent.
SCOPE, REACH = 3, 4
#: Symbols are a class plus marks; marks are bits above the classes.
TARGETED, NEGATED, REPORTED_MARK, STACKED, INTENDED = 8, 16, 32, 64, 128
SYMBOLS = range(256)
#: What an arc that sets a mark multiplies the weight of its word by.
FACTORS = {TARGETED: 1.5, NEGATED: 0.25, REPORTED_MARK: 0.5, STACKED: 1.25, INTENDED: 1.5}
#: What a clause can be accepted as: the first of these whose marks one of its words has.
PATTERNS = ("negated", "reported", "targeted", "threat", "stacked", "lone")
EVIDENCE = (*PATTERNS, "largest", "spread")
#: Weights without training: intercept, then one per evidence column.
PRIOR = (-3.0, 0.05, 0.1, 1.2, 1.2, 0.9, 0.0, 0.0, 0.0)


@dataclass
class Transducer:
    """A deterministic weighted transducer over marked classes: (state, symbol) to (state, symbol, factor of weight)."""

    arcs: dict[tuple[int, int], tuple[int, int, float]]
    start: int = 0

    def step(self, state: int, symbol: int) -> tuple[int, int, float]:
        return self.arcs.get((state, symbol), (state, symbol, 1.0))

    def compose(self, after: Transducer, symbols: range) -> Transducer:
        """The machine that feeds what this one writes to the next one."""
        number = {(self.start, after.start): 0}
        todo, arcs = [(self.start, after.start)], {}
        while todo:
            pair = todo.pop()
            for symbol in symbols:
                one, middle, w1 = self.step(pair[0], symbol)
                two, out, w2 = after.step(pair[1], middle)
                if (one, two) not in number:
                    number[one, two] = len(number)
                    todo.append((one, two))
                arcs[number[pair], symbol] = (number[one, two], out, w1 * w2)
        return Transducer(arcs)


def base_class(symbol: int) -> int:
    return symbol & 7


def is_abuse(symbol: int) -> bool:
    return base_class(symbol) in (INSULT_, THREAT_)


def marking(opens: int, mark: int, reach: int | None, marks: tuple[int, ...] = (INSULT_, THREAT_)) -> Transducer:
    """After a word of one class, abuse of the classes `marks` gets a mark: to the clause's end, or so many words far.

    States count the words that are left; without reach, state 1 lasts.
    """
    arcs = {}
    full = reach or 1
    for s in SYMBOLS:
        if base_class(s) == opens:
            for left in range(full + 1):
                arcs[left, s] = (full, s, 1.0)
        else:
            for left in range(1, full + 1):
                hit = base_class(s) in marks
                arcs[left, s] = (left - 1 if reach else left, s | mark if hit else s, FACTORS[mark] if hit else 1.0)
    return Transducer(arcs)


def insult_machine() -> Transducer:
    """An insult after another one of its clause is stacked; negated and reported ones open no stack."""
    arcs = {}
    for s in SYMBOLS:
        if base_class(s) == INSULT_ and not s & (NEGATED | REPORTED_MARK):
            arcs[0, s] = (1, s, 1.0)
            arcs[1, s] = (1, s | STACKED, FACTORS[STACKED])
    return Transducer(arcs)


def threat_machine() -> Transducer:
    """Violence near a verb of intent is a threat."""
    return marking(INTENT_, INTENDED, REACH, (THREAT_,))


def grammar() -> Transducer:
    """All five clause machines composed; what each writes the next one reads."""
    found = marking(TARGET_, TARGETED, None)
    for machine in (marking(NEGATION_, NEGATED, SCOPE), marking(REPORTED_, REPORTED_MARK, None), insult_machine(), threat_machine()):
        found = found.compose(machine, range(8))
    return found


GRAMMAR = grammar()


def pattern_of(symbols: list[int]) -> int:
    """The pattern of a clause's abuse: negated or reported if all of it is, else by what stands out most."""
    plain = [s for s in symbols if not s & (NEGATED | REPORTED_MARK)]
    if not plain:
        return 0 if all(s & NEGATED for s in symbols) else 1
    if any(s & TARGETED for s in plain):
        return 2
    if any(s & INTENDED for s in plain):
        return 3
    return 4 if len(plain) > 1 else 5


@dataclass
class Lexicon:
    """The lexical transducer: words and word beginnings with a class and a weight."""

    words: dict[str, tuple[int, float]] = field(default_factory=dict)
    beginnings: dict[str, tuple[int, float]] = field(default_factory=dict)
    _automaton: object = None

    def automaton(self):
        """All entries as one automaton; built once a worker."""
        if self._automaton is None:
            import ahocorasick

            found = ahocorasick.Automaton()
            for word in {*self.words, *self.beginnings}:
                found.add_word(word, word)
            if len(found):
                found.make_automaton()
            self._automaton = found
        return self._automaton

    def __getstate__(self) -> dict:
        return {"words": self.words, "beginnings": self.beginnings, "_automaton": None}

    def read(self, word: str) -> tuple[int, float]:
        """Class and weight of a word: as a whole, else by its longest known beginning."""
        found = self.words.get(word)
        for size in range(min(len(word), PREFIXES[-1]), PREFIXES[0] - 1, -1):
            if found:
                break
            found = self.beginnings.get(word[:size])
        return found or CUES.get(word, (OTHER_, 0.0))


def entries(text: str, kind: int, weight: float) -> dict[str, tuple[int, float]]:
    return dict.fromkeys(text.split(), (kind, weight))


CUES = entries(INTENT, INTENT_, 0.0) | entries(TARGET, TARGET_, 0.0) | entries(NEGATION, NEGATION_, 0.0) | entries(REPORTED, REPORTED_, 0.0)


SEEDS = entries(INSULT, INSULT_, 2.0) | entries(THREAT, THREAT_, 2.0)


def seeds() -> Lexicon:
    return Lexicon(dict(SEEDS))


def clauses(text: str, lexicon: Lexicon) -> Iterator[str]:
    """The clauses of a text in which an entry may stand, in order."""
    automaton = lexicon.automaton()
    if not len(automaton):
        return
    end = -1
    for last, entry in automaton.iter(text):
        first = last - len(entry) + 1
        if first <= end or (first and text[first - 1].isalnum()):
            continue
        begin = max((text.rfind(c, 0, first) for c in ".!?;:\n")) + 1
        stop = CLAUSE_END.search(text, last + 1)
        end = stop.start() if stop else len(text)
        yield text[begin:end]


def match(clause: str, lexicon: Lexicon) -> tuple[int, float] | None:
    """(pattern, weight of its path) of a lower-case clause that the composed machine accepts."""
    state, total, symbols = GRAMMAR.start, 0.0, []
    for m in WORD.finditer(clause):
        kind, weight = lexicon.read(m.group())
        state, symbol, factor = GRAMMAR.step(state, kind)
        if is_abuse(symbol):
            total += weight * factor
            symbols.append(symbol)
    return (pattern_of(symbols), total) if symbols else None


def evidence(text: str | None, lexicon: Lexicon) -> list[float]:
    """Matched clauses by EVIDENCE column.

    By pattern, the weights of the clauses per hundred words; then the largest clause's weight and the logarithm of the
    number of matched clauses.
    """
    out = [0.0] * len(EVIDENCE)
    matched = 0
    for clause in clauses((text or "").lower(), lexicon):
        if found := match(clause, lexicon):
            pattern, weight = found
            out[pattern] += weight
            out[-2] = max(out[-2], weight)
            matched += 1
    if matched:
        words = len(text.split())
        out[:-2] = [math.log1p(100 * v / max(words, 1)) for v in out[:-2]]
        out[-2], out[-1] = math.log1p(out[-2]), math.log1p(matched)
    return out


def features_of(text: str) -> Iterator[str]:
    """Each word ("=word") and, of words that are no seeds, its beginnings ("word"), as often as they are found."""
    for word in WORD.findall(text.lower()):
        if len(word) >= PREFIXES[0] and word.isalpha():
            yield "=" + word
            if word not in SEEDS:
                for k in PREFIXES:
                    if k >= len(word):
                        break
                    yield word[:k]


def crc32_of(id_col: Column) -> Column:
    return F.crc32(id_col.cast("string").cast("binary"))


def held_out(id_col: Column) -> Column:
    return F.coalesce(crc32_of(id_col) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(text, toxic) of at most so many labelled rows that are not held out, least hash first."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = known.where(~held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # At most `sample` ids of 12 bytes: a proven bound.
    return texts.join(F.broadcast(chosen), "doc_id").select("text", (F.col("toxic") > 0).alias("toxic"))


def counted(rows: DataFrame) -> DataFrame:
    """(feature, toxic, clean): how often each feature stands in either; put together in the worker before the shuffle."""
    schema = pa.schema([("feature", pa.string()), ("toxic", pa.int64()), ("clean", pa.int64())])

    def run(batches):
        tally: tuple[Counter[str], Counter[str]] = (Counter(), Counter())

        def rows_of() -> dict[str, list]:
            names = [*{**tally[0], **tally[1]}]
            out = {"feature": names, "toxic": [tally[0][n] for n in names], "clean": [tally[1][n] for n in names]}
            tally[0].clear()
            tally[1].clear()
            return out

        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = Counter(features_of(text or ""))
                tally[0 if toxic else 1].update({name: min(n, PER_DOCUMENT) for name, n in own.items()})
                if len(tally[0]) + len(tally[1]) > 200_000:
                    yield rows_of()
        yield rows_of()

    found = rows.select("text", "toxic").mapInArrow(arrow_rows(run, schema), "feature string, toxic long, clean long")
    return found.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def learn_lexicon(rows: DataFrame, of_toxic: int, of_clean: int) -> Lexicon:
    """Seeds and what the rows teach, given the words of either kind. Weights are log ratios of rates, less so many standard deviations."""
    lexicon = seeds()
    t, c = F.col("toxic") + 0.5, F.col("clean") + 0.5
    weight = F.ln(t / F.lit(of_toxic + 1.0)) - F.ln(c / F.lit(of_clean + 1.0)) - F.lit(DEVIATIONS) * F.sqrt(1 / t + 1 / c)
    telling = counted(rows).where(F.col("toxic") >= MIN_TOXIC).withColumn("weight", F.round(weight, 6)).where(F.col("weight") >= math.log(MIN_RATIO))
    # Those that explain most go first; of a beginning and its extensions only one is taken. Extensions are a few a word.
    first = telling.orderBy(F.desc(F.round(F.col("toxic") * F.col("weight"), 3)), F.desc(F.length("feature")), "feature").limit(LEXICON * (len(PREFIXES) + 1))
    taken: list[str] = []
    for name, weight in [(r.feature, r.weight) for r in first.collect()]:
        plain = name.lstrip("=")
        if len(taken) < LEXICON and not any(plain.startswith(t) or t.startswith(plain) for t in taken if t[0] == plain[0]):
            taken.append(plain)
            kind = lexicon.words.get(plain, (INSULT_, 0.0))[0]
            (lexicon.words if name[0] == "=" else lexicon.beginnings)[plain] = (kind, weight)
    return lexicon


def fit(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, steps: int = 30) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the intercept is not penalised."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(x.shape[1])
    ridge = np.diag([1e-6, *[penalty] * (x.shape[1] - 1)])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        move = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
        w = w + move
        if np.abs(move).max() < 1e-8:
            break
    return w


@dataclass
class Model:
    lexicon: Lexicon
    weights: tuple[float, ...] = PRIOR

    def score(self, text: str | None) -> float:
        z = self.weights[0] + sum(a * b for a, b in zip(self.weights[1:], evidence(text, self.lexicon), strict=True))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn the lexicon and the weights from labelled rows that are not held out."""
    rows = table(training_rows(docs, labels, sample), "training")
    sizes = {r.toxic: r.words for r in rows.groupBy("toxic").agg(F.sum(F.size(F.split(F.coalesce("text", F.lit("")), r"\s+"))).alias("words")).collect()}
    if not sizes.get(True) or not sizes.get(False):
        return Model(seeds())
    lexicon = learn_lexicon(rows, sizes[True], sizes[False])
    schema = pa.schema([("toxic", pa.bool_()), *((n, pa.float64()) for n in EVIDENCE)])

    def run(batches):
        for batch in batches:
            found = [evidence(t, lexicon) for t in batch.column(0).to_pylist()]
            yield {"toxic": batch.column(1), **{n: [f[k] for f in found] for k, n in enumerate(EVIDENCE)}}

    got = rows.mapInArrow(arrow_rows(run, schema), "toxic boolean, " + ", ".join(f"{n} double" for n in EVIDENCE)).collect()
    data = np.array([[float(v) for v in r] for r in sorted(got)])
    return Model(lexicon, tuple(fit(data[:, 1:], data[:, 0]).tolist()))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])

    def run(batches):
        for batch in batches:
            scores = [model.score(t) for t in batch.column(1).to_pylist()]
            yield {"doc_id": batch.column(0), "held_out": batch.column(2), "score": scores, "predicted": [int(s >= 0.5) for s in scores]}

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.withColumn("held_out", held_out(F.col("doc_id"))).mapInArrow(
        arrow_rows(run, schema), "doc_id long, held_out boolean, score double, predicted int"
    )


def reject(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The documents whose score is below the threshold, with all their columns."""
    small_batches(docs.sparkSession)
    schema = docs.schema

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            yield batch.filter(pa.array([model.score(t) < threshold for t in batch.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, schema)
