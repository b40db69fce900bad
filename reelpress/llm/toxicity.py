"""Toxicity by a weighted finite-state pattern grammar.

A text is read as clauses of word classes: insult, threat, intent, target, negation, report, other, and
stops. Small transducers rewrite such a sequence one after the other and are composed into one table:

* ``threats``: intent, threat and target in this order within a clause become a made threat;
* ``negation``: what follows a negation within three words is marked as negated;
* ``reports``: what follows a verb of saying within the sentence is marked as reported;
* ``targets``: what follows a person addressed within the clause is marked as aimed.

What comes out are matches with marks. Their weights are summed over clauses, apart for plain, aimed, negated and
reported matches and threats; these sums, the weight per word and the share of clauses with a match
make the score by a logistic function.

Insults are learned: word beginnings of 3 to 8 letters, and whole words, that stand more often in texts labelled toxic, over
all labelled rows. An entry must tell more (by its log-likelihood ratio) than chance would in any of so many beginnings;
its weight is the log of the rates' ratio less one standard error. A few common insults are known from the start, and
counts join what is known of them. The lexicon keeps its ``LEXICON`` strongest entries and is broadcast. The logistic function is
fitted on a bounded sample of at most ``SAMPLE`` labelled rows, each scored with a lexicon that was learned
from the other half of the rows, so that weights of chance entries are not believed.

Defined results: null and empty texts have no match; rows without a label, and labels without a text,
are not learned from; labels of one id that differ count as their largest; without any label the weights
known from the start are used; repeated rows are scored alike; an empty table gives an empty result; input
columns named like a result column are replaced.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelpress.llm.common import text_of, without
from reelpress.session import use_checkpoints

#: Entries of the lexicon, at most; so many are broadcast.
LEXICON = 20_000
#: Labelled rows that the logistic function is fitted on, at most, chosen by a hash of their ids.
SAMPLE = 20_000
#: Beginnings counted in a task before they are given out.
COUNTED = 300_000
#: Words whose classes a task remembers.
REMEMBERED = 300_000
#: Letters of the beginnings.
SHORTEST, LONGEST = 3, 8
#: Characters read at a time.
PORTION = 1 << 20
RESULT = ("score", "predicted")

# ---- fixed values: words of the grammar ---------------------------------------------------
WORDS = {
    "insult": "idiot moron stupid scum loser trash pathetic worthless disgusting imbecile dumb "
    "bastard jerk crap dumm dummkopf trottel abschaum blöd widerlich verlierer stupide crétin "
    "imbécile débile ordure minable estúpido idiota imbécil basura escoria asqueroso patético",
    "intent": "will gonna shall must should werde wirst soll muss vais va dois voy vas debes",
    "threat": "kill hurt destroy shoot stab die töten umbringen vernichten sterben tuer détruire mourir "
    "matar destruir morir",
    "target": "you your yours yourself he she they him them du dich dir sie ihr tu toi te vous il elle "
    "ils tú ti usted ustedes él ella ellos",
    "negation": "not no never neither nor nicht kein keine nie ne pas jamais non nunca jamás ni",
    "report": "said says told claimed called quoted wrote reported sagte sagt nannte schrieb dit "
    "disait appelait écrit dijo dice llamó escribió",
}
# -------------------------------------------------------------------------------------------

CLASSES = ("other", "insult", "threat", "intent", "target", "negation", "report", "stop", "end")
OTHER, INSULT, THREAT, INTENT, TARGET, NEGATION, REPORT, STOP, END = range(len(CLASSES))
MADE = len(CLASSES)  # a threat that was made, out of the grammar's parts
NEGATED, REPORTED, AIMED = 16, 32, 64  # marks on what comes out

Machine = dict[tuple, tuple]  # (state, symbol) -> (state, symbol); state 0 is the first


def machine(step, symbols) -> Machine:
    """The table of all states that ``step`` reaches from 0."""
    table, waiting, seen = {}, [0], {0}
    while waiting:
        state = waiting.pop()
        for symbol in symbols:
            after, out = table[state, symbol] = step(state, symbol)
            if after not in seen:
                seen.add(after)
                waiting.append(after)
    return table


def _marked(symbol: int, mark: int) -> int:
    return symbol | mark if symbol & 15 in (INSULT, MADE) else symbol


def threats(state: int, symbol: int) -> tuple[int, int]:
    if symbol in (STOP, END):
        return 0, symbol
    if symbol == TARGET and state == 2:
        return 1, MADE
    return max(state, {INTENT: 1, THREAT: 2 if state else 0}.get(symbol, 0)), symbol


def negation(state: int, symbol: int) -> tuple[int, int]:
    if symbol in (STOP, END):
        return 0, symbol
    if symbol == NEGATION:
        return 3, symbol
    return max(0, state - 1), _marked(symbol, NEGATED) if state else symbol


def reports(state: int, symbol: int) -> tuple[int, int]:
    if symbol == END:
        return 0, symbol
    return int(state or symbol == REPORT), _marked(symbol, REPORTED) if state else symbol


def targets(state: int, symbol: int) -> tuple[int, int]:
    if symbol in (STOP, END):
        return 0, symbol
    aimed = state or symbol & 15 == MADE
    return int(aimed or symbol == TARGET), _marked(symbol, AIMED) if aimed else symbol


def compose(first: Machine, second) -> Machine:
    """The machine that feeds what ``first`` writes to the step function ``second``."""
    symbols = {symbol for _, symbol in first}
    names: dict[tuple, int] = {(0, 0): 0}

    def step(state: int, symbol: int) -> tuple[int, int]:
        one, two = next(pair for pair, name in names.items() if name == state)
        one, symbol = first[one, symbol]
        two, symbol = second(two, symbol)
        return names.setdefault((one, two), len(names)), symbol

    return machine(step, symbols)


def grammar() -> Machine:
    table = machine(threats, range(len(CLASSES)))
    for step in (negation, reports, targets):
        table = compose(table, step)
    return table


_tokens = re.compile(r"[^\W\d_]+|[.,;:!?\n]").findall
_inside = re.compile(r"[.,;:!?\n\s]")


def portions(text: str) -> Iterator[list[str]]:
    """Words and stops of a lower-cased text, a bounded portion at a time."""
    at = 0
    while at < len(text):
        cut = _inside.search(text, at + PORTION) if at + PORTION < len(text) else None
        upto = cut.end() if cut else len(text)
        yield _tokens(text[at:upto].lower())
        at = upto


def beginnings(word: str) -> list[str]:
    return [word[:n] for n in range(SHORTEST, min(LONGEST, len(word)) + 1)] + [f"{word}$"]


_KNOWN = {word: CLASSES.index(kind) for kind, words in WORDS.items() for word in words.split()}
_STOPS = {",": STOP, ";": STOP, ":": STOP, ".": END, "!": END, "?": END, "\n": END}
FEATURES = ("one", "plain", "aimed", "negated", "reported", "threat", "density", "share")
#: Logistic weights that are used where nothing speaks against them.
PRIOR = np.array([-4.0, 0.4, 0.6, 0.1, 0.2, 2.0, 0.5, 1.0])


class _Classes(dict):
    """Word -> (class, weight)."""

    def __init__(self, lexicon: dict[str, float]):
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, word: str) -> tuple[int, float]:
        if len(self) >= REMEMBERED:
            for old in list(islice(self, REMEMBERED // 2, None)):
                del self[old]
        kind = _STOPS.get(word) or _KNOWN.get(word, OTHER)
        weight = 0.0
        if kind in (OTHER, INSULT):
            weight = max(map(self.lexicon.get, beginnings(word), [0.0] * (LONGEST + 2)))
            kind = INSULT if weight > 0 else OTHER
        self[word] = kind, weight
        return kind, weight


def features(text: str, classes: _Classes, table: Machine) -> np.ndarray:
    made = np.zeros(len(FEATURES))
    state = words = clauses = matched = 0
    hit = False
    for tokens in portions(text):
        known = [classes[t] for t in tokens]
        kinds = np.fromiter((k for k, _ in known), np.int8, len(known))
        stops = kinds >= STOP
        words += len(known) - int(stops.sum())
        clauses += int(stops.sum())
        if len(text) <= PORTION and not ((kinds == INSULT) | (kinds == THREAT)).any():
            continue  # nothing comes out, and no later portion needs the state
        for kind, weight in known:
            state, out = table[state, kind]
            if out & 15 == INSULT or out & 15 == MADE:
                hit = True
                if out & 15 == MADE:
                    at = 5
                    weight = 1.0
                else:
                    at = 3 if out & NEGATED else 4 if out & REPORTED else 2 if out & AIMED else 1
                made[at] += weight
            elif kind >= STOP:
                matched += hit
                hit = False
    made[0] = 1
    made[6] = 100 * made[1:5].sum() / max(1, words)
    made[7] = (matched + hit) / (clauses + 1)
    made[1:6] = np.log1p(made[1:6])
    made[6] = np.log1p(made[6])
    return made


def held_out(doc_id: str = "doc_id"):
    """Rows that are never learned from: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(_remainder(doc_id) == 1, F.lit(False))


def _remainder(doc_id: str):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Beginnings by half and label (slots 0 to 3), and how many toxic texts have them (slot 4).

    A word counts once in a text, so that what one text repeats does not outweigh many texts.
    """
    counts: list[Counter[str]] = [Counter() for _ in range(5)]
    for batch in batches:
        for half, toxic, text in batch.itertuples(index=False):
            slot = counts[2 * half + toxic]
            words = {word for tokens in portions(text) for word in tokens if word not in _STOPS}
            slot[""] += len(words)
            starts = [start for word in words for start in beginnings(word)]
            slot.update(starts)
            if toxic:
                counts[4].update(set(starts))
            if sum(map(len, counts)) >= COUNTED:
                yield _count_frame(counts)
                for each in counts:
                    each.clear()
    yield _count_frame(counts)


def _count_frame(counts: list[Counter[str]]) -> pd.DataFrame:
    starts = list(set().union(*counts))
    columns = {f"n{slot}": pd.Series([each[s] for s in starts], dtype="int64") for slot, each in enumerate(counts)}
    return pd.DataFrame({"start": pd.Series(starts, dtype=object), **columns})


def _gain(t, c, total_t: float, total_c: float):
    """Twice the log-likelihood ratio of ``t`` and ``c`` against equal rates; columns or arrays."""
    log = F.log if hasattr(t, "cast") else np.log
    share = total_t / (total_t + total_c)
    return 2 * (t * log((t + 1e-9) / ((t + c + 1e-9) * share)) + c * log((c + 1e-9) / ((t + c + 1e-9) * (1 - share))))


def _weights(starts, t, c, total_t, total_c, least: float) -> dict[str, float]:
    """Entries with what they weigh: log ratio of rates less a standard error."""
    total_t, total_c = max(total_t, 1.0), max(total_c, 1.0)
    known = {f"{w}$" for w, kind in _KNOWN.items() if kind == INSULT}
    lexicon = dict.fromkeys(known, 4.0)
    if len(starts):
        t, c = np.asarray(t, float), np.asarray(c, float)
        seen = np.array([s in known for s in starts])
        good = (_gain(t, c, total_t, total_c) >= least) & (t * total_c > 3 * c * total_t) & (t >= 3)
        ratio = np.log((t + 0.5) / (c + 0.5) * (total_c / total_t)) - np.sqrt(1 / (t + 0.5) + 1 / (c + 0.5))
        for i in np.flatnonzero(good | (seen & (t + c >= 20))).tolist():
            lexicon[starts[i]] = float(ratio[i])
    return {start: w for start, w in lexicon.items() if w > 0}


def learn(labelled: DataFrame, text: str = "text", toxic: str = "toxic", doc_id: str = "doc_id") -> tuple:
    """(lexicon, logistic weights) of labelled rows; their ids tell the two halves."""
    spark = labelled.sparkSession
    use_checkpoints(spark)
    half = (F.coalesce(_remainder(doc_id), F.lit(0)) == 0).cast("int")
    rows = labelled.where(F.col(text).isNotNull() & F.col(toxic).isNotNull()).select(
        F.col(doc_id).alias("id"), half.alias("half"), (F.col(toxic) > 0).cast("int").alias("toxic"), F.col(text).alias("text")
    )
    slots = [f"n{slot}" for slot in range(5)]
    counts = (
        rows.select("half", "toxic", "text")
        .mapInPandas(_count, f"start string, {', '.join(f'{slot} long' for slot in slots)}")
        .groupBy("start")
        .agg(*[F.sum(slot).alias(slot) for slot in slots])
        .where("n1 + n3 >= 3 AND (n4 >= 3 OR start = '')")
        .checkpoint()
    )
    whole = counts.where("start = ''").first()
    if whole is None:
        return _weights([], [], [], 0, 0, 0), PRIOR
    n0, n1, n2, n3 = whole["n0"], whole["n1"], whole["n2"], whole["n3"]
    least = 2 * math.log(counts.count()) + 4
    t, c = F.col("n1") + F.col("n3"), F.col("n0") + F.col("n2")
    gain = _gain(t, c, max(n1 + n3, 1), max(n0 + n2, 1))
    found = (
        counts.where("start != ''")
        .where(t * (n0 + n2) > 3 * c * (n1 + n3))
        .withColumn("gain", gain)
        .where(F.col("gain") >= least)
        .orderBy(F.desc("gain"), "start")
        .limit(LEXICON)
        .collect()
    )
    starts = [row["start"] for row in found]
    col = lambda i: np.array([row[f"n{i}"] for row in found], float)
    halves = [
        _weights(starts, col(1), col(0), n1, n0, least / 2),
        _weights(starts, col(3), col(2), n3, n2, least / 2),
    ]
    lexicon = _weights(starts, col(1) + col(3), col(0) + col(2), n1 + n3, n0 + n2, least)
    shared = spark.sparkContext.broadcast((halves, grammar()))

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lexicons, table = shared.value
        classes = [_Classes(words) for words in lexicons]
        for batch in batches:
            made = [
                features(text, classes[1 - half], table).tobytes()
                for half, text in zip(batch["half"], batch["text"], strict=True)
            ]
            yield pd.DataFrame({"toxic": batch["toxic"], "x": pd.Series(made, dtype=object)})

    share = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)) / F.lit(1 << 30)
    n = rows.count()
    chosen = rows.where(share < SAMPLE / max(n, 1)).select("half", "toxic", "text")
    sample = chosen.mapInPandas(vectors, "toxic int, x binary").limit(2 * SAMPLE).collect()
    x = np.array([np.frombuffer(row["x"]) for row in sample]).reshape(-1, len(FEATURES))
    return lexicon, fit(x, np.array([row["toxic"] for row in sample], float))


def fit(x: np.ndarray, y: np.ndarray, steps: int = 30, pull: float = 2.0) -> np.ndarray:
    """Logistic weights by Newton steps, drawn to ``PRIOR`` as if by a few rows."""
    w = PRIOR.copy()
    for _ in range(steps if len(y) else 0):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - pull * (w - PRIOR)
        bend = (x * (p * (1 - p))[:, None]).T @ x + pull * np.eye(len(w))
        w = w + np.clip(np.linalg.solve(bend, slope), -2, 2)
    return w


def score_texts(docs: DataFrame, model: tuple, text: str = "text", bound: float = 0.7) -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (1 from ``bound`` on)."""
    shared = docs.sparkSession.sparkContext.broadcast((*model, grammar()))

    @F.pandas_udf("double")
    def tell(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        lexicon, w, table = shared.value
        classes = _Classes(lexicon)
        for texts in parts:
            x = np.array([features(t, classes, table) for t in texts]).reshape(-1, len(FEATURES))
            yield pd.Series(1 / (1 + np.exp(-np.clip(x @ w, -30, 30))))

    plain = without(docs.withColumn("__text", text_of(text)), *RESULT)
    return (
        plain.withColumn("score", tell("__text"))
        .withColumn("predicted", (F.col("score") >= bound).cast("int"))
        .drop("__text")
    )


def toxicity(
    docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", toxic: str = "toxic"
) -> DataFrame:
    """Learns from the labelled rows that are not held out and scores all rows."""
    known = labels.where(F.col(toxic).isNotNull()).groupBy(F.col(doc_id).alias("l_id")).agg(F.max(toxic).alias("l_toxic"))
    rows = docs.where(~held_out(doc_id)).select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    # labels grow with the documents, so they are not broadcast at any size
    labelled = rows.join(known.hint("merge"), F.col("doc_id") == F.col("l_id")).select("doc_id", "text", F.col("l_toxic").alias("toxic"))
    return score_texts(docs, learn(labelled), text)
