"""Toxicity by a weighted finite-state grammar over clauses.

Three transducers are composed. The first turns words into classes: insult, threat, target,
negation, report. The second reads the classes of a clause and holds how far back a negation,
a target and a report are, and whether one of these is near what was matched. The third turns what a
clause ends in into one of a few kinds of matched clause. Clause kinds are what is scored:
an isolated insult, one at a target, a negated one, a quoted one, and so for threats.

Which words are insults is learned: words and word stems that come in documents marked toxic
far more often than in others. How much each kind of clause says is learned, too.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.text import map_texts, slices
from marquee.session import shared_dir

# Words of the grammar in English, German, French and Spanish.
INSULTS = "idiot moron imbecile fool dumb stupid ugly pathetic loser scum trash filth vermin disgusting worthless"
THREATS = "kill hurt destroy murder strangle stab shoot burn töte töten umbringen schlage tuer frapper détruire matar golpear destruir"
TARGETS = "you your yours he she they them him her his their du dich dein ihr euch euer tu toi ton vous votre usted ustedes vosotros"
NEGATIONS = "not no never none cannot isn't aren't don't won't nicht kein keine nie ne pas jamais nunca jamás ni"
REPORTS = "said says told wrote quoted called reported alleged sagte schrieb nannte dit disait écrit appelé dijo escribió llamó"

NONE, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)

#: Labelled rows that are learned from, at most. It bounds what is broadcast and what is fitted.
TRAIN_ROWS = 30_000
#: Share of rows held out, as one in so many by the checksum of the id.
FOLDS = 5

#: Lengths of word stems that may be learned, share of toxic documents that must hold a word or stem, and log odds
#: from which it counts as an insult.
STEMS = (4, 5, 6, 7)
MIN_SHARE = 0.002
MIN_COUNT = 5
MIN_ODDS = 3.0

KINDS = ("insult", "insult_at", "insult_negated", "insult_reported", "threat", "threat_at", "threat_negated",
         "threat_reported")
#: Kinds that are meant as they are said.
PLAIN = frozenset(k for k in KINDS if not k.endswith(("negated", "reported")))
#: What a text is scored by: log of 1 + clauses of each kind, the weight of the strongest clause that is neither negated nor
#: reported, and matched clauses per hundred words.
FEATURES = [*KINDS, "strongest", "density"]

KEPT_WORDS = 600_000
_EDGE = re.compile(r"^[\W\d_]+|[\W\d_]+$")
_CLAUSE_END = re.compile(r"[.,;:!?|)]['\"]?$")


def bare(word: str) -> str:
    """A word in lower case without what surrounds its letters."""
    return _EDGE.sub("", word).lower()


def terms(word: str) -> Iterator[str]:
    """A bare word and its stems, which end in a star."""
    yield word
    for n in STEMS:
        if len(word) > n:
            yield word[:n] + "*"


def held_out(doc: Column) -> Column:
    return F.crc32(doc.cast("string").cast("binary")) % FOLDS == 0


class Lexicon(dict):
    """The first transducer: a word as it stands to class and weight, remembered."""

    def __init__(self, learned: dict[str, float]):
        super().__init__()
        self._learned = learned
        fixed = ((INSULTS, INSULT), (THREATS, THREAT), (TARGETS, TARGET), (NEGATIONS, NEGATION), (REPORTS, REPORT))
        self._fixed = {w: kind for text, kind in reversed(fixed) for w in text.split()}

    def __missing__(self, word: str) -> tuple[int, float] | None:
        plain = bare(word)
        weight = max((self._learned.get(t, 0.0) for t in terms(plain)), default=0.0) if plain else 0.0
        if weight:
            found = INSULT, weight
        else:
            kind = self._fixed.get(plain, NONE)
            found = (kind, MIN_ODDS if kind in (INSULT, THREAT) else 0.0) if kind else None
        if len(self) > KEPT_WORDS:
            self.clear()
        self[word] = found
        return found


#: Words over which a negation holds, and within which a target or report belongs to an insult or threat.
NEGATED_OVER = 3
NEAR = 6

#: The matched class, its reading, for how many words yet a negation, target and report hold, for how many yet a target
#: or report belongs to what was matched, and whether one did.
State = tuple[int, str, int, int, int, int, bool, bool]
_START: State = (NONE, "", 0, 0, 0, 0, False, False)


class _Moves(dict):
    """The composed second and third transducers: from state and class to state, made when first asked for.

    Each part of a state is a small automaton of its own; there are as many states as their
    parts have together, and few of them are ever seen.
    """

    def __missing__(self, move: tuple[State, int]) -> State:
        (matched, reading, negation, target, report, hit, reported, addressed), symbol = move
        if symbol in (INSULT, THREAT):
            if symbol >= matched:  # a threat outweighs an insult, a plain reading a negated one
                own = "negated" if negation else ""
                reading = own if symbol > matched else reading and own
            matched = max(matched, symbol)
            reported, addressed = reported or report > 0, addressed or target > 0
        else:
            reported = reported or symbol == REPORT and hit > 0
            addressed = addressed or symbol == TARGET and hit > 0
        state = (matched, reading, _left(negation, NEGATED_OVER, symbol == NEGATION), _left(target, NEAR, symbol == TARGET),
                 _left(report, NEAR, symbol == REPORT), _left(hit, NEAR, symbol in (INSULT, THREAT)), reported, addressed)
        self[move] = state
        return state


def _left(words: int, whole: int, anew: bool) -> int:
    return whole if anew else max(0, words - 1)


def clause_kind(state: State) -> int | None:
    """What a clause that ends in a state says: a place in ``KINDS``, or None where nothing was matched."""
    matched, reading, *_, reported, addressed = state
    if not matched:
        return None
    name = "insult" if matched == INSULT else "threat"
    return KINDS.index(f"{name}_negated" if reading else f"{name}_reported" if reported else
                       f"{name}_at" if addressed else name)


_MOVES = _Moves()


def features(text: str, lexicon: Lexicon) -> list[float]:
    """The numbers of ``FEATURES`` for one text. A line break ends a clause, as a mark at a word's end does."""
    counts = [0] * len(KINDS)
    strongest, n_words = 0.0, 0
    for line in text.splitlines():
        words = line.split()
        n_words += len(words)
        found = [lexicon[w] for w in words]
        if not any(f is not None and f[0] <= THREAT for f in found):
            continue
        state, weight, last = _START, 0.0, len(words) - 1
        for at, (word, one) in enumerate(zip(words, found)):
            state = _MOVES[state, one[0] if one else NONE]
            if one and one[1] > weight:
                weight = one[1]
            if at == last or _CLAUSE_END.search(word):
                kind = clause_kind(state)
                if kind is not None:
                    counts[kind] += 1
                    if KINDS[kind] in PLAIN and weight > strongest:
                        strongest = weight
                state, weight = _START, 0.0
    density = 100 * sum(counts) / n_words if n_words else 0.0
    return [*(math.log1p(c) for c in counts), strongest, math.log1p(density)]


def _counted(rows: DataFrame, among: frozenset[str] | None) -> DataFrame:
    """In how many rows each word and stem comes; with ``among`` only of those. Batches are added up first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 8 << 20):
                count: Counter[str] = Counter()
                for text in part.column("text").to_pylist():
                    held = {t for w in set(map(bare, set(text.split()))) if w for t in terms(w)}
                    count.update(held if among is None else held & among)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(count), pa.string()), pa.array(list(count.values()), pa.int64())],
                    names=["term", "n"])

    return rows.select("text").mapInArrow(run, "term string, n bigint").groupBy("term").agg(F.sum("n").alias("n"))


def training_rows(df: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """Texts and labels that are learned from: at most ``TRAIN_ROWS``, by a hash of the id, none held out.

    The labels taken are few by that bound, so they are broadcast and no text is shuffled.
    """
    shared_dir(df.sparkSession)
    usable = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where(
        "id IS NOT NULL AND label IS NOT NULL").where(~held_out(F.col("id")))
    # Only labels whose hash is below one that a few more than wanted lie under are put in order.
    share = min(1.0, 1.25 * TRAIN_ROWS / max(1, usable.count()))
    low = usable.where(F.xxhash64("id") <= min((1 << 63) - 1, int(share * 2.0 ** 64) - (1 << 63)))
    taken = low.orderBy(F.xxhash64("id"), "id", "label").limit(TRAIN_ROWS)
    texts = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return texts.join(F.broadcast(taken), "id").select("id", "text", "label").checkpoint()


def learn_words(rows: DataFrame) -> dict[str, float]:
    """Words and stems with the log odds by which they mark toxic texts.

    Only those in enough toxic texts come to the driver; their number is bounded by the words
    of a text over ``MIN_SHARE``, whatever the size of the corpus.
    """
    toxic, clean = rows.where("label = 1"), rows.where("label = 0")
    n_toxic, n_clean = toxic.count(), clean.count()
    if not n_toxic or not n_clean:
        return {}
    least = max(MIN_COUNT, math.ceil(MIN_SHARE * n_toxic))
    often = {t: n for t, n in _counted(toxic, None).where(F.col("n") >= least).collect()}
    seldom = {t: n for t, n in _counted(clean, frozenset(often)).collect()}
    odds = {t: math.log((n + 0.5) / (n_toxic + 1)) - math.log((seldom.get(t, 0) + 0.5) / (n_clean + 1))
            for t, n in often.items()}
    marked = {t: n for t, n in often.items() if odds[t] >= MIN_ODDS}
    return {t: odds[t] for t in _telling(marked)}


def _telling(counts: dict[str, int]) -> list[str]:
    """Words and stems without the stems that one longer word or stem accounts for."""
    kept, under = [], Counter()
    for term in sorted(counts, key=lambda t: (-len(t.rstrip("*")), t.endswith("*"))):
        stem = term.rstrip("*")
        if term.endswith("*") and under[stem] >= 0.8 * counts[term]:
            continue
        kept.append(term)
        for n in STEMS:
            if n <= len(stem):
                under[stem[:n]] = max(under[stem[:n]], counts[term])
    return kept


class Model:
    """What has been learned: the words, and weights for the features."""

    def __init__(self, words: dict[str, float], weights: list[float], bias: float):
        self.words, self.weights, self.bias = words, weights, bias

    def score(self, df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """``id_col``, the ``features`` and the ``score`` from 0 to 1 of each row; null texts count as empty."""
        rows = measured(df, id_col, text_col, self.words)
        sums = [F.col("features")[n] * w for n, w in enumerate(self.weights)]
        total = sum(sums[1:], sums[0]) + F.lit(self.bias)
        return rows.withColumn("score", 1 / (1 + F.exp(-total)))


def measured(df: DataFrame, id_col: str, text_col: str, words: dict[str, float]) -> DataFrame:
    held: list[Lexicon] = []

    def each(texts: list[str]) -> list[list]:
        if not held:
            held.append(Lexicon(words))
        return [[features(t, held[0]) for t in texts]]

    return map_texts(df, id_col, text_col, each, {"features": pa.list_(pa.float64())})


def fit(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic") -> Model:
    """Learn words, then weights, from the labelled rows that aren't held out.

    Without rows of both labels every text scores the share of the one there is, or 0.5.
    """
    rows = training_rows(df, labels, id_col, text_col, label_col)
    shares = rows.agg(F.count("*"), F.sum("label")).first()
    if not shares[0] or shares[1] in (0, shares[0]):
        share = (shares[1] + 0.5) / (shares[0] + 1) if shares[0] else 0.5
        return Model({}, [0.0] * len(FEATURES), math.log(share / (1 - share)))
    words = learn_words(rows)
    seen = measured(rows, "id", "text", words).join(rows.select("id", "label"), "id").select(
        array_to_vector("features").alias("features"), F.col("label").cast("double").alias("label"))
    fitted = LogisticRegression(regParam=1e-3, maxIter=60).fit(seen)
    return Model(words, [float(w) for w in fitted.coefficients], float(fitted.intercept))


def toxicity(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "toxic") -> DataFrame:
    """``id_col``, ``held_out``, ``score`` and ``predicted`` (1 from 0.5 on) of each row.

    Only the text decides the score. A null or empty text scores what texts without any
    matched clause score. Rows that repeat are scored each; a null id is not held out.
    """
    scored = fit(df, labels, id_col, text_col, label_col).score(df, id_col, text_col)
    return scored.select(id_col, F.coalesce(held_out(F.col(id_col)), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
