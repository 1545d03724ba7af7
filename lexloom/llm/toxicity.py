"""Toxicity by weak supervision: voters, a generative label model, and a linear classifier on its posteriors.

Voters are the words of a lexicon, patterns, and forms of words that labelled texts show to go with toxicity.
What they say of all texts, labelled or not, is counted, and the label model learns their accuracies and
correlations from these counts by expectation-maximisation, anchored by the labelled ones.  The classifier is
trained on the posteriors of a sample of texts: of votes alone where there is no label, of votes and the label,
as one more voter of estimated accuracy, where there is one.  Labels apart from these calibrate its odds.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sampling import bounded_sample, held_out
from .shared import staged, text_column
from .shipping import ship

#: Labelled rows that the classifier is fitted on, about, other rows beside them, and bytes of distinct words of each, at most.
TRAIN_ROWS, OTHER_ROWS, TRAIN_BYTES = 6_000, 2_000, 48_000_000
#: Weight of a row without a label: voters overlook some of what labels know.
OTHER_WEIGHT = 0.1
#: A mined voter's form occurs in at least so many labelled texts.
LEAST_TEXTS = 5
#: Rounds of expectation-maximisation, and those after which correlations are estimated.
ROUNDS, CORRELATED = 8, (1, 4)
#: A correlation from which on voters share their weight.
CLOSE = 0.5
#: Posteriors are summed in such units, so that sums do not depend on their order.
UNIT = 1 << 30
# A lexicon of insults in the languages at hand.
LEXICON = """idiot moron stupid loser scum pathetic worthless disgusting trash clown dumb imbecile jerk creep filthy
idioten dummkopf arschloch abschaum widerlich erbärmlich versager trottel
imbécile crétin connard ordure minable débile abruti dégoûtant
imbécil estúpido basura asqueroso patético inútil escoria payaso""".split()
# Patterns that often go with abuse, each with what a text must hold for it to be tried.
PATTERNS = {
    # Tried only where a run of capitals begins, and never given back: linear in any text.
    "shouting": ("", re.compile(r"(?<![A-ZÀ-Þ])[A-ZÀ-Þ]{2,}+(?:\W++[A-ZÀ-Þ]{2,}+){4}")),
    "bangs": ("", re.compile(r"[!?]{3}")),
    "address": ("ou", re.compile(r"\b[Yy]ou(?:'re| are)\b.{0,20}\b(?:" + "|".join(LEXICON[:15]) + r")\b", re.S)),
    "starred": ("**", re.compile(r"\w\*\*")),
}


def pattern_found(name: str, text: str) -> bool:
    held, pattern = PATTERNS[name]
    return held in text and pattern.search(text) is not None


_WORDS = re.compile(r"[^\W\d_]+").findall
_PREFIXES = (4, 5, 6, 7)


def distinct_words(text: str) -> set[str]:
    return set(_WORDS(text.lower()))


def word_features(word: str) -> list[str]:
    """What the classifier and the mined voters see of a word: itself and its beginnings."""
    return ["=" + word, *("^" + word[:n] for n in _PREFIXES if len(word) > n)]


@dataclass(frozen=True)
class Voters:
    """Forms of words that vote, after them the patterns, and last the silence of all forms: a vote is a number."""

    forms: dict[str, int]

    @property
    def size(self) -> int:
        return len(self.forms) + len(PATTERNS) + 1

    def votes(self, words, flags) -> np.ndarray:
        """Who says something of a text, in order; all others abstain."""
        said = {self.forms[f] for w in words for f in word_features(w) if f in self.forms} or {self.size - 1}
        return np.array(sorted(said | {len(self.forms) + i for i, flag in enumerate(flags) if flag}), "<u2")


@dataclass
class LabelModel:
    """Class-conditional rates of each voter, and the weight left to it beside voters it goes with.

    A vote moves the odds by the ratio of its rates; an abstention says nothing, only the silence of all forms
    does, as a voter of its own, for a text of one language lacks the forms of all others.  Given the class,
    voters are taken as independent but for their correlation within the classes: where two agree beyond
    what the classes explain, the weight of both is lowered, so a family of voters that see the same thing
    does not count as many.  Voters whose vote is right less often than not have no place here.
    """

    toxic_rate: np.ndarray
    clean_rate: np.ndarray
    weight: np.ndarray
    prior: float

    def log_odds(self, votes: list[np.ndarray]) -> np.ndarray:
        said = np.log(self.toxic_rate / self.clean_rate) * self.weight
        own = np.repeat(np.arange(len(votes)), [len(v) for v in votes])
        flat = np.concatenate([np.zeros(0, np.int64), *votes]).astype(np.int64)
        return np.log(self.prior / (1 - self.prior)) + np.bincount(own, said[flat], minlength=len(votes))

    def posterior(self, votes: list[np.ndarray]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.log_odds(votes), -40, 40)))

    def expected(self, votes: list[np.ndarray], counts: np.ndarray, pairs: bool) -> dict[tuple[int, int], tuple[int, int]]:
        """Expected toxic texts and all texts of each voter (i, i), in all (-1, -1) and, if asked for, of pairs."""
        toxic, k = np.rint(self.posterior(votes) * UNIT).astype(np.int64) * counts, len(self.weight)
        out: Counter = Counter()
        every: Counter = Counter()
        for own, t, n in zip(votes, toxic.tolist(), counts.tolist(), strict=True):
            out[-1], every[-1] = out[-1] + t, every[-1] + n
            ids = own.tolist()
            for at, i in enumerate(ids):
                for j in ids[at:] if pairs else (i,):
                    out[i * k + j] += t
                    every[i * k + j] += n
        return {(-1, -1) if key < 0 else divmod(key, k): (out[key], every[key]) for key in every}

    def updated(self, sums: dict[tuple[int, int], tuple[int, int]], anchor: dict[tuple[int, int], tuple[int, int]], pairs: bool) -> LabelModel:
        """The model of the next round from sums over all texts and those of the labelled ones (``anchor``)."""
        k = len(self.weight)
        toxic, every = (np.zeros((k, k)) for _ in range(2))
        all_toxic, all_texts = (sums[-1, -1][i] + anchor[-1, -1][i] for i in (0, 1))
        for told in (sums, anchor):
            for (i, j), (t, n) in told.items():
                if i >= 0:
                    toxic[i, j] += t / UNIT
                    every[i, j] += n
        t, n = all_toxic / UNIT, float(all_texts)
        c = n - t
        a = np.clip((np.diag(toxic) + 0.05) / (t + 1), 1e-6, 1 - 1e-4)
        b = np.clip((np.diag(every - toxic) + 0.05) / (c + 1), 1e-6, 1 - 1e-4)
        weight = self.weight
        if pairs:
            # Covariances within the classes, pooled: what the classes leave unexplained.
            within = (toxic - t * np.outer(a, a)) + (every - toxic - c * np.outer(b, b))
            within = np.triu(within, 1) + np.triu(within, 1).T
            spread = np.sqrt(t * a * (1 - a) + c * b * (1 - b)) + 1e-9
            close = within / np.outer(spread, spread)
            weight = 1 / (1 + np.where(close > CLOSE, close, 0).sum(axis=1))
        return LabelModel(a, b, weight, float(np.clip(t / n, 1e-3, 1 - 1e-3)))

    @classmethod
    def fit(cls, count, labelled: list[np.ndarray], labels: np.ndarray, size: int) -> LabelModel:
        """``count(model, pairs)`` gives the expected sums over all texts; labelled votes start and anchor it."""
        given = cls(np.full(size, 0.5), np.full(size, 0.5), np.ones(size), 0.5)
        anchor: dict[tuple[int, int], list[int]] = {(-1, -1): [int(labels.sum()) * UNIT, len(labels)]}
        for own, y in zip(labelled, labels.tolist(), strict=True):
            ids = own.tolist()
            for at, i in enumerate(ids):
                for j in ids[at:]:
                    sums = anchor.setdefault((i, j), [0, 0])
                    sums[0], sums[1] = sums[0] + y * UNIT, sums[1] + 1
        known = {key: tuple(v) for key, v in anchor.items()}
        model = given.updated({(-1, -1): (0, 0)}, known, True)
        for turn in range(ROUNDS):
            pairs = turn in CORRELATED
            model = model.updated(count(model, pairs), known, pairs)
        return model


@dataclass
class ToxicityModel:
    """A linear classifier: a bias and one weight a feature, summed over the distinct words of a text."""

    bias: float = -3.0
    weights: dict[str, float] = field(default_factory=dict)
    patterns: dict[str, float] = field(default_factory=dict)

    def __post_init__(self):
        # No word can have a weight unless its first letters begin a weighted feature.
        self.begins = {f[1:][: _PREFIXES[0]] for f in self.weights}

    def odds(self, words, flags) -> float:
        n, begins = _PREFIXES[0], self.begins
        hits = sorted(w for w in words if w[:n] in begins)
        told = sum(self.weights.get(f, 0.0) for w in hits for f in word_features(w))
        return self.bias + told + sum(self.patterns.get(name, 0.0) for name, flag in zip(PATTERNS, flags, strict=True) if flag)

    def score(self, text: str) -> float:
        flags = [bool(self.patterns.get(name)) and pattern_found(name, text) for name in PATTERNS]
        return float(1 / (1 + np.exp(-np.clip(self.odds(distinct_words(text), flags), -40, 40))))


def _features(texts: list[list[str]]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Names of the features that enough texts have, and (text, feature, count of distinct words) of each text.

    Most forms are rare, so forms are first counted by 64-bit hashes; only what is common gets a name.
    """
    from xxhash import xxh64_intdigest

    vocabulary: dict[str, int] = {}
    seen = [np.fromiter((vocabulary.setdefault(w, len(vocabulary)) for w in words), np.int32) for words in texts]
    sizes = np.fromiter((len(word_features(w)) for w in vocabulary), np.int64, len(vocabulary))
    hashes = np.fromiter((xxh64_intdigest(f) for w in vocabulary for f in word_features(w)), np.uint64, int(sizes.sum()))
    kinds, flat = np.unique(hashes, return_inverse=True)
    flat, first, n_kinds = flat.astype(np.int32), np.cumsum(sizes) - sizes, len(kinds)
    del hashes, kinds

    def counted():
        for a in range(0, len(texts), 250):  # some texts at a time, so that the repeated features stay small
            own = seen[a : a + 250]
            words, of = np.concatenate([np.zeros(0, np.int32), *own]), np.repeat(np.arange(a, a + len(own)), [len(x) for x in own])
            n = sizes[words]
            place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[words], n)
            key, count = np.unique(np.repeat(of, n) * max(1, n_kinds) + flat[place], return_counts=True)
            yield (key // max(1, n_kinds)).astype(np.int32), (key % max(1, n_kinds)).astype(np.int32), count.astype(np.float32)

    spread = np.zeros(n_kinds, np.int64)
    for _, col, _ in counted():
        spread += np.bincount(col, minlength=n_kinds)
    common = spread >= LEAST_TEXTS
    place = np.cumsum(common) - 1
    names: list[str] = [""] * int(common.sum())
    at = 0
    for w in vocabulary:
        for f in word_features(w):
            if common[flat[at]]:
                names[place[flat[at]]] = f
            at += 1
    parts = [(row[keep], place[col[keep]].astype(np.int32), count[keep]) for row, col, count in counted() for keep in [common[col]]]
    if not parts:
        return names, np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.float32)
    return names, *(np.concatenate(c) for c in zip(*parts, strict=True))


@dataclass
class Sample:
    """The labelled texts that a model is fitted on: their distinct words, what patterns found, and labels."""

    words: list[list[str]]
    flags: np.ndarray
    labels: np.ndarray

    def part(self, chosen: np.ndarray) -> Sample:
        return Sample([w for w, c in zip(self.words, chosen, strict=True) if c], self.flags[chosen], self.labels[chosen])

    def decided(self) -> bool:
        return min(self.labels.sum(), (1 - self.labels).sum()) >= LEAST_TEXTS


def mined_voters(names: list[str], row: np.ndarray, col: np.ndarray, labels: np.ndarray) -> Voters:
    """The lexicon and every form whose lift in toxic texts holds up against chance among so many forms.

    That is: log-odds above four standard errors, and at two still such that its vote alone is right more often
    than not.  Of forms of which one begins another the one that says
    most of toxic texts votes for all; a word of the lexicon does so in any case.  The first texts of the
    features are the labelled ones.
    """
    col, row = col[row < len(labels)], row[row < len(labels)]
    in_toxic = np.bincount(col, labels[row], minlength=len(names))
    in_clean = np.bincount(col, 1 - labels[row], minlength=len(names))
    toxic, clean = int(labels.sum()), int(len(labels) - labels.sum())
    lift = np.log((in_toxic + 0.5) / (toxic + 1)) - np.log((in_clean + 0.5) / (clean + 1))
    error = np.sqrt(1 / (in_toxic + 0.5) + 1 / (in_clean + 0.5))
    sure = np.minimum(lift - 4 * error, lift - 2 * error - np.log(clean / toxic))
    worth = sure * in_toxic
    forms = dict.fromkeys("=" + w for w in LEXICON)
    taken = {w[:n] for w in LEXICON for n in range(1, len(w) + 1)}  # beginnings of forms that vote
    whole = set(LEXICON)
    for c in sorted(np.flatnonzero((in_toxic >= LEAST_TEXTS) & (sure > 0)).tolist(), key=lambda c: (-worth[c], names[c])):
        letters = names[c][1:]
        if letters not in taken and not any(letters[:n] in whole for n in range(1, len(letters))):
            forms[names[c]] = None
            whole.add(letters)
            taken.update(letters[:n] for n in range(1, len(letters) + 1))
    return Voters({f: i for i, f in enumerate(forms)})


def trained(names: list[str], row: np.ndarray, col: np.ndarray, val: np.ndarray, flags: np.ndarray, aim: np.ndarray, weight: np.ndarray, steps: int = 200) -> ToxicityModel:
    """A sparse linear classifier of the posteriors ``aim``, on every form that is common enough."""
    n, beyond = len(aim), flags.astype(float)
    w, v, b = np.zeros(len(names)), np.zeros(len(PATTERNS)), float(np.log((weight @ aim) / (weight @ (1 - aim))))
    # Full-batch proximal steps of a diagonal second-order method: few features end up with any weight.
    scale = np.bincount(col, weight[row] * val**2, minlength=len(names)) * 0.25 + 5
    for _ in range(steps):
        odds = b + np.bincount(row, w[col] * val, minlength=n) + beyond @ v
        off = weight * (1 / (1 + np.exp(-np.clip(odds, -40, 40))) - aim)
        w = w - 0.3 * np.bincount(col, off[row] * val, minlength=len(names)) / scale
        w = np.sign(w) * np.maximum(0, np.abs(w) - 0.3 * 0.5 / scale)
        v = np.maximum(0, v - 0.3 * (beyond.T @ off + v) / (0.25 * weight @ beyond + 20))  # a pattern never excuses
        b -= 0.3 * off.sum() / (0.25 * weight.sum())
    keep = np.flatnonzero(w)
    return ToxicityModel(float(b), {names[i]: float(w[i]) for i in keep}, dict(zip(PATTERNS, v.tolist(), strict=True)))


def _calibrated(model: ToxicityModel, sample: Sample) -> ToxicityModel:
    """Scale and shift the odds so that they are those of the labels (with one row of doubt on each side).

    Both classes weigh the same in all, so a rare class is not given up for the common one.
    """
    labels, odds = sample.labels, np.array([model.odds(w, f) for w, f in zip(sample.words, sample.flags.tolist(), strict=True)])
    toxic, clean = labels.sum(), len(labels) - labels.sum()
    aim = np.where(labels == 1, (toxic + 1) / (toxic + 2), 1 / (clean + 2))
    middle, spread = float(np.median(odds)), float(odds.std()) + 1e-9
    x = np.stack([(odds - middle) / spread, np.ones(len(odds))], axis=1)

    weight = np.where(labels == 1, clean / toxic, 1.0)

    def loss(t: np.ndarray) -> float:
        z = x @ t
        return float((weight * (np.logaddexp(0, z) - aim * z)).sum() + 1e-3 * (t @ t))

    t, now = np.array([1.0, 0.0]), loss(np.array([1.0, 0.0]))
    for _ in range(50):  # Newton steps, halved until they help
        p = 1 / (1 + np.exp(-np.clip(x @ t, -40, 40)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + 2e-3 * np.eye(2), x.T @ (weight * (p - aim)) + 2e-3 * t)
        size = 1.0
        while size > 1e-6 and (then := loss(t - size * step)) > now:
            size /= 2
        if size <= 1e-6 or now - then < 1e-9:
            break
        t, now = t - size * step, then
    t = np.array([max(t[0], 0.1) / spread, 0]) + np.array([0, t[1] - max(t[0], 0.1) * middle / spread])
    return ToxicityModel(float(model.bias * t[0] + t[1]), {f: w * float(t[0]) for f, w in model.weights.items()}, {f: w * float(t[0]) for f, w in model.patterns.items()})


def _words_of(rows: DataFrame, most: int, most_bytes: int) -> Sample:
    """A bounded sample of ``id, y, text`` as distinct words, found where the texts are."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() for t in batch.column(2)]
            told = pa.array([" ".join(sorted(distinct_words(t))) for t in texts], pa.string())
            flags = pa.array(["".join("01"[pattern_found(name, t)] for name in PATTERNS) for t in texts], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), told, flags], names=["id", "y", "words", "flags"])

    told = staged(rows.mapInArrow(read, "id string, y int, words string, flags string").distinct(), "toxicity-sample")
    size = told.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("words") + 8), F.lit(0)).alias("bytes")).first()
    share = min(1.0, most / max(1, size.n), most_bytes / max(1, size.bytes))  # an id can have many texts, a text many words
    if share < 1:
        told = told.where(F.pmod(F.xxhash64("words", "id"), F.lit(2**40)) < int(share * 2**40))
    got = told.toArrow().sort_by([("id", "ascending"), ("words", "ascending"), ("flags", "ascending"), ("y", "ascending")])
    flags = np.array([[c == "1" for c in f] for f in got["flags"].to_pylist()], bool).reshape(-1, len(PATTERNS))
    held: dict[str, str] = {}  # one string a word, however many texts hold it
    words = [[held.setdefault(w, w) for w in text.as_py().split()] for text in got["words"]]
    return Sample(words, flags, np.array(got["y"].to_pylist(), np.int64))


def _samples(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, most: int) -> tuple[Sample, Sample]:
    """Labelled texts and any texts (their labels unread), none of them held out."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_l")).agg(F.max(F.col(label_col).cast("int")).alias("_y"))
    known = bounded_sample(known.where(~held_out("_l")), "_l", most)
    rows = docs.where(~held_out(id_col)).select(F.col(id_col).alias("_id"), text_column(text_col).alias("_t"))
    of = lambda df, y: df.select(F.col("_id").cast("string").alias("id"), y.cast("int").alias("y"), F.col("_t").alias("text"))
    labelled = _words_of(of(rows.join(known, F.col("_id") == F.col("_l")), F.col("_y")), most, TRAIN_BYTES)
    others = _words_of(of(bounded_sample(rows, "_id", OTHER_ROWS), F.lit(0)), OTHER_ROWS, TRAIN_BYTES)
    return labelled, others


def with_labels(odds: np.ndarray, labels: np.ndarray, rounds: int = 5) -> np.ndarray:
    """Posteriors of votes and labels, a label being one more voter whose rates are estimated, too."""
    p = 1 / (1 + np.exp(-np.clip(odds, -40, 40)))
    for _ in range(rounds):
        of_toxic, of_clean = (float(np.clip((w @ labels + 0.5) / (w.sum() + 1), 0.01, 0.99)) for w in (p, 1 - p))
        said = np.where(labels == 1, np.log(of_toxic / of_clean), np.log((1 - of_toxic) / (1 - of_clean)))
        p = 1 / (1 + np.exp(-np.clip(odds + said, -40, 40)))
    return p


def vote_counts(docs: DataFrame, voters: Voters, id_col: str, text_col: str) -> DataFrame:
    """``votes, n``: how many texts, of all that are not held out, have just these votes; labels are not read."""
    begins = {f[1:][: _PREFIXES[0]] for f in voters.forms}

    def cast(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told: Counter = Counter()
        for batch in batches:
            for t in batch.column(0):
                text = t.as_py()
                words = [w for w in distinct_words(text) if w[: _PREFIXES[0]] in begins]
                told[voters.votes(words, [pattern_found(name, text) for name in PATTERNS]).tobytes()] += 1
            if len(told) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(list(told), pa.binary()), pa.array(list(told.values()), pa.int64())], names=["votes", "n"])
                told = Counter()
        yield pa.RecordBatch.from_arrays([pa.array(list(told), pa.binary()), pa.array(list(told.values()), pa.int64())], names=["votes", "n"])

    rows = docs.where(~held_out(id_col)).select(text_column(text_col).alias("text"))
    return rows.mapInArrow(cast, "votes binary, n long").groupBy("votes").agg(F.sum("n").alias("n"))


def _counting(counts: DataFrame):
    """Sums over a table of vote counts under a model, added up where the counts are."""

    def count(model: LabelModel, pairs: bool) -> dict[tuple[int, int], tuple[int, int]]:
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                votes = [np.frombuffer(v, "<u2") for v in batch.column(0).to_pylist()]
                sums = model.expected(votes, batch.column(1).to_numpy(zero_copy_only=False), pairs)
                if sums:
                    i, j = zip(*sums, strict=True)
                    t, n = zip(*sums.values(), strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (i, j, t, n)], names=["i", "j", "t", "n"])

        told = counts.mapInArrow(add, "i long, j long, t long, n long").groupBy("i", "j").agg(F.sum(F.col("t").cast("decimal(38,0)")).alias("t"), F.sum("n").alias("n"))
        got = {(r.i, r.j): (int(r.t), r.n) for r in told.collect()}  # voters, or pairs of them, at most
        return {(-1, -1): (0, 0)} | got

    return count


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", most: int = TRAIN_ROWS) -> ToxicityModel:
    """Voters and classifier from bounded samples of rows that are not held out, the label model from all of these.

    ``most`` bounds the labelled rows.  A row with a null label is not labelled; where an id has several
    labels, 1 wins.  Three quarters of the labelled rows give the voters, anchor the label model and train the
    classifier, together with other rows; the last quarter calibrates its odds.
    """
    sample, others = _samples(docs, labels, id_col, text_col, label_col, most)
    if not len(sample.labels) or sample.labels.min() == sample.labels.max():
        share = float(np.clip(sample.labels.mean() if len(sample.labels) else 0.01, 1e-3, 1 - 1e-3))
        return ToxicityModel(bias=float(np.log(share / (1 - share))))
    apart = np.arange(len(sample.labels)) % 4 == 3
    fitted, judged = (sample.part(~apart), sample.part(apart)) if sample.part(~apart).decided() and sample.part(apart).decided() else (sample, sample)
    names, row, col, val = _features(fitted.words + others.words)
    voters = mined_voters(names, row, col, fitted.labels)
    of = lambda s: [voters.votes(w, f) for w, f in zip(s.words, s.flags.tolist(), strict=True)]
    votes = of(fitted)
    model = LabelModel.fit(_counting(staged(vote_counts(docs, voters, id_col, text_col), "toxicity-votes")), votes, fitted.labels, voters.size)
    aim = np.concatenate([with_labels(model.log_odds(votes), fitted.labels), model.posterior(of(others))])
    weight = np.concatenate([np.ones(len(fitted.words)), np.full(len(others.words), OTHER_WEIGHT)])
    return _calibrated(trained(names, row, col, val, np.concatenate([fitted.flags, others.flags]), aim, weight), judged)


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", most: int = TRAIN_ROWS) -> DataFrame:
    """One row a document: id, ``held_out, score`` (0 to 1) and ``predicted`` (1 from 0.5 on).

    The score depends on the whole text alone; null text is the empty text and is scored, too.  Each row
    stands for itself, also where ids repeat or are null.  With no labels, or of one kind only, every text
    has the share of toxic labels as its score.  An empty table gives none; other columns are not read.
    """
    ship(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, id_col, text_col, label_col, most))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = model.value.score
        for batch in batches:
            odds = np.array([of(t.as_py()) for t in batch.column(2)])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(odds, pa.float64()), pa.array((odds >= 0.5).astype(np.int32))], names=["id", "held_out", "score", "predicted"])

    rows = docs.select(F.col(id_col).alias("id"), held_out(id_col).alias("held_out"), text_column(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(judge, f"id {kind}, held_out boolean, score double, predicted int").withColumnRenamed("id", id_col)


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", threshold: float = 0.5, most: int = TRAIN_ROWS) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more; its own columns and no others."""
    ship(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, id_col, text_col, label_col, most))

    @F.pandas_udf("boolean")
    def toxic(texts):
        return texts.map(lambda t: model.value.score(t) >= threshold)

    return docs.where(~toxic(text_column(text_col)))
