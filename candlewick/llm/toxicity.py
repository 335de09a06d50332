"""Toxicity: deobfuscate words by a noisy channel, then score the restored text by learnt cues.

Channel: a writer may swap letters for look-alikes, put marks or spaces between them, or repeat them.
Each odd word is a lattice of what its characters may stand for; Viterbi decoding under a character
trigram model, counted over all texts, finds the likeliest word.  Cues are restored words and their
beginnings (which catch inflections), learnt from labelled documents: features that hardly occur in
clean texts are taken greedily, each for the toxic texts that no earlier cue covers.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .charmodel import gram_counts, symbols
from .common import held_out, map_texts, read, ship, tidied, whole_text
from .perplexity import KneserNey

THRESHOLD = 0.3
#: Labelled documents of each kind that cues are learnt from at most, chosen by a hash of the id.
TOXIC_ROWS, CLEAN_ROWS = 6_000, 18_000
#: Features that come to the driver at most, and texts that a cue must cover.
CANDIDATES, MIN_TEXTS, MIN_PRECISION = 60_000, 3, 0.55
#: Cues that are sought for each toxic text, so that one is left where a text has only some of them.
COVER = 4
PREFIXES = (4, 5, 6, 7)
MEMO_WORDS, MEMO_CHARS = 400_000, 32  # words that a task remembers, and their length (cache sizes)

# Letters that look like a digit or mark.
LOOK_ALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c",
}
EDGES = ".,;:?\"')[]{}«»“”„…¿¡`´"
SWAP, DROP_MARK, DROP_REPEAT, DROP_DOUBLE, DROP_LOOK_ALIKE = 1.5, 0.7, 0.5, 4.0, 3.0  # costs in nats
LONGEST = 60  # characters of an odd word that is decoded at a time; a longer one is decoded in parts
_TRIPLE = re.compile(r"(.)\1\1")


class Channel:
    """Decodes odd words with a table of trigram log-probabilities."""

    def __init__(self, model: KneserNey | None):
        every = np.arange(64**3, dtype=np.uint32)
        self.table = model.log_probability(every).astype(np.float32) if model else np.zeros(64**3, np.float32)

    def decode(self, word: str, breaks: bool = False) -> str:
        """The likeliest reading of a word; of a run of words, parted by spaces, if it may have breaks."""
        states = {(0, 0): (0.0, "")}
        inner = [i for i, c in enumerate(word) if c.isalnum()] or [0]
        for i, char in enumerate(word):
            options = [(letter, -SWAP) for letter in LOOK_ALIKES.get(char, "")]
            if char.isalpha():
                options.append((char, 0.0))
                if i and word[i - 1] == char:
                    options.append(("", -(DROP_REPEAT if char * 3 in word else DROP_DOUBLE)))
            elif char.isdigit():
                options.append((char, 0.0))
            else:
                options.append(("", -(DROP_LOOK_ALIKE if options and inner[0] < i < inner[-1] else DROP_MARK)))
            coded = [(letter, cost, int(symbols(letter)[0]) if letter else -1) for letter, cost in options]
            new: dict = {}
            for (a, b), (score, text) in states.items():
                for letter, cost, c in coded:
                    if c < 0:
                        key, value = (a, b), score + cost
                    else:
                        key, value = (b, c), score + cost + float(self.table[a << 12 | b << 6 | c])
                    if key not in new or value > new[key][0]:
                        new[key] = (value, text + letter)
            if breaks and i < len(word) - 1:
                for (a, b), (score, text) in list(new.items()):
                    key, value = (b, 0), score + float(self.table[a << 12 | b << 6])
                    if b and (key not in new or value > new[key][0]):
                        new[key] = (value, text + " ")
            states = new
        return max((score + float(self.table[a << 12 | b << 6]), text) for (a, b), (score, text) in states.items())[1]

    def restored(self, token: str) -> str:
        """A word in lower case without marks at its ends, decoded if it is odd."""
        word = token.lower().strip(EDGES)
        plain = word.strip("!$@|+*#%&(-_/\\~^=<>")
        if plain.isalpha() and not _TRIPLE.search(plain):
            at = word.index(plain)
            if not any(c in LOOK_ALIKES for c in word[:at] + word[at + len(plain) :]):
                return plain
        if not any(c.isalpha() or c in LOOK_ALIKES for c in word):
            return ""
        return "".join(self.decode(word[i : i + LONGEST]) for i in range(0, len(word), LONGEST))


    def words(self, token: str) -> list[str]:
        """The words that a token is restored to: one, or those of a spelled-out run."""
        if " " not in token:
            return [self.restored(token)]
        run = token.lower().replace(" ", "")
        parts = (run[i : i + LONGEST] for i in range(0, len(run), LONGEST))
        return [w for part in parts for w in self.decode(part, breaks=True).split()]

    def features(self, token: str) -> list[str]:
        """Features of a token's words; of a spelled-out run those that it hasn't as one word, which is a token too."""
        found = [f for w in self.words(token) for f in word_features(w)]
        joined = word_features(self.restored(token.replace(" ", ""))) if " " in token else []
        return [f for f in found if f not in joined]


def spelled_out(words: list[str]) -> list[str]:
    """Runs of three or more single characters that stand one after the other: as one word, and with
    spaces, for a reading as several words."""
    out, run = [], []
    for i in [i for i, w in enumerate(words) if len(w) == 1] + [-2]:
        if run and i != run[-1] + 1:
            if len(run) > 2:
                out += ["".join(words[j] for j in run), " ".join(words[j] for j in run)]
            run = []
        run.append(i)
    return out


def tokens(text: str) -> set[str]:
    words = text.split()
    return set(words).union(spelled_out(words))


def word_features(word: str) -> list[str]:
    return [word[:n] + "*" for n in PREFIXES if len(word) > n] + [word] if word else []


def text_features(text: str, channel: Channel, wanted: set[str] | None = None) -> set[str]:
    """Features of the text's words; f#2 and f#3 where two or three different words have f."""
    seen = Counter(f for token in tokens(text) for f in channel.features(token))
    found = {f for f in seen} | {f"{f}#{k}" for f, n in seen.items() for k in (2, 3) if n >= k}
    return found if wanted is None else found & wanted


class Cues:
    """Cues with their precision; the score of a text is 1 minus the product of their errors."""

    def __init__(self, channel: Channel, weights: dict[str, float], rest: float):
        self.channel, self.weights, self.rest = channel, weights, rest
        self.levels: dict[str, list[tuple[int, float]]] = {}
        for cue, weight in weights.items():
            stem, _, level = cue.partition("#")
            self.levels.setdefault(stem, []).append((int(level or 1), weight))
        self.memo: dict[str, tuple[str, ...]] = {}

    def forget(self) -> None:
        self.memo.clear()

    def stems(self, token: str) -> tuple[str, ...]:
        return tuple(f for f in self.channel.features(token) if f in self.levels)

    def found(self, text: str) -> list[tuple[str, float]]:
        """Cues of a text, each with the weight of the highest level that it reaches."""
        memo, seen = self.memo, Counter()
        if len(memo) > MEMO_WORDS:
            memo.clear()
        for token in tokens(text):
            if (stems := memo.get(token)) is None:
                stems = self.stems(token)
                if len(token) <= MEMO_CHARS:
                    memo[token] = stems
            if stems:
                seen.update(stems)
        reached = {f: [w for level, w in self.levels[f] if n >= level] for f, n in seen.items()}
        return sorted((f, max(w)) for f, w in reached.items() if w)

    def score(self, text: str) -> float:
        return 1 - (1 - self.rest) * float(np.prod([1 - weight for _, weight in self.found(text)]))


def _counts(texts: DataFrame, channel, name: str, wanted=None) -> DataFrame:
    """(feature, name): in how many texts each feature is; added up per partition first."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter = Counter()
        for frame in frames:
            for text in frame["__text"]:
                total.update(text_features(text, channel.value, wanted.value if wanted else None))
        if total:
            yield pd.DataFrame({"feature": list(total), "n": list(total.values())})

    return ship(texts).mapInPandas(tidied(count), "feature string, n long").groupBy("feature").agg(F.sum("n").alias(name))


def learnt(docs: DataFrame, labels: DataFrame) -> Cues:
    """Cues from labelled documents that are not held out; copies of a text count once."""
    sc = docs.sparkSession.sparkContext
    counts = gram_counts(docs, order=3, fold=True).toPandas()  # 64**3 rows at most
    model = KneserNey(counts["gram"].to_numpy(), counts["n"].to_numpy(), 3) if len(counts) else None
    channel = sc.broadcast(Channel(model))
    known = labels.where(F.col("toxic").isin(0, 1) & ~held_out(4, 2)).select("doc_id", "toxic").distinct()

    def sample(kind: int, rows: int) -> DataFrame:
        ids = known.where(F.col("toxic") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).select("doc_id")
        return docs.join(F.broadcast(ids), "doc_id").select(whole_text().alias("__text")).distinct()

    toxic, clean = sample(1, TOXIC_ROWS), sample(0, CLEAN_ROWS)
    frequent = _counts(toxic, channel, "a").where(F.col("a") >= MIN_TEXTS)
    found = frequent.orderBy(F.desc("a"), "feature").limit(CANDIDATES).toPandas().set_index("feature")
    wanted = sc.broadcast(set(found.index))
    found = found.join(_counts(clean, channel, "b", wanted).toPandas().set_index("feature")).fillna(0)
    n = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = {1: max(1.0, n.get(1, 0) / TOXIC_ROWS), 0: max(1.0, n.get(0, 0) / CLEAN_ROWS)}
    found["b"] *= share[0] / share[1]  # as many clean texts to each toxic one as among all labels
    found["precision"] = found["a"] / (found["a"] + found["b"] + 2)
    found = found[found["precision"] >= MIN_PRECISION]
    chosen = sc.broadcast(set(found.index))

    def row(texts: list[str]) -> dict:
        return {"found": [sorted(text_features(t, channel.value, chosen.value)) for t in texts]}

    rows = map_texts(toxic.withColumnRenamed("__text", "text"), row, "found array<string>", ()).toPandas()["found"]
    texts = sorted({tuple(x) for x in rows})
    weights = greedy_cover(texts, found["precision"].to_dict(), found["b"].to_dict())
    covered = sum(any(f in weights for f in t) for t in rows)
    missed = (len(rows) - covered) * share[1]
    rest = min(0.2, (missed + 0.5) / (missed + n.get(0, 0) + 1))
    for used in (channel, wanted, chosen):
        used.unpersist()
    return Cues(channel.value, weights, rest)


def related(a: str, b: str) -> bool:
    """Whether one is a beginning of the other; a short word is related to itself alone."""
    return a == b if min(len(a), len(b)) < PREFIXES[0] else a.startswith(b) or b.startswith(a)


def greedy_cover(texts: list[tuple[str, ...]], precision: dict[str, float], clean: dict[str, float]) -> dict[str, float]:
    """Features taken one by one, each the one that most texts with less than COVER cues hold; few clean
    texts and longer features first among equals.  Of a word and its beginnings only one is taken."""
    holders: dict[str, set[int]] = {}
    for i, text in enumerate(texts):
        for f in text:
            holders.setdefault(f, set()).add(i)
    least = max(MIN_TEXTS, len(texts) // 200)  # fewer may hold a rare word by chance
    chosen: dict[str, float] = {}
    cues = [0] * len(texts)
    while holders:
        best = max(holders, key=lambda f: (len(holders[f]) * precision[f], -clean[f], len(f), f))
        covered = holders.pop(best)
        if len(covered) < least:
            break
        chosen[best] = precision[best]
        stem = best.partition("#")[0].rstrip("*")
        for i in covered:
            cues[i] += 1
        full = {i for i in covered if cues[i] >= COVER}
        for f in [f for f in holders if related(stem, f.partition("#")[0].rstrip("*"))]:
            del holders[f]
        if full:
            holders = {f: left for f, own in holders.items() if len(left := own - full) >= MIN_TEXTS}
    return chosen


def score(docs: DataFrame, cues: Cues) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted, cues found.

    Null and empty texts get the score of texts without a cue; repeated rows are scored each; other
    columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(cues)  # CANDIDATES cues and a 64**3 table at most

    def row(texts: list[str]) -> dict:
        return {"score": [sent.value.score(t) for t in texts]}

    scored = map_texts(docs, row, "score double", done=lambda: sent.value.forget())
    predicted = (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    return scored.select("doc_id", held_out(4, 2).alias("held_out"), "score", predicted)


def without_toxic(docs: DataFrame, cues: Cues) -> DataFrame:
    """docs, whole rows, without those whose score reaches THRESHOLD; equal rows fare alike."""
    sent = docs.sparkSession.sparkContext.broadcast(cues)

    def clean(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = frame["text"].where(frame["text"].notna(), "")
            passed = frame[[sent.value.score(t) < THRESHOLD for t in texts]]
            if len(passed):
                yield passed

    return ship(docs).mapInPandas(tidied(clean, lambda: sent.value.forget()), docs.schema)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    return score(docs, learnt(docs, labels))
